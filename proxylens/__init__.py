"""Spark-native analytics for web-proxy and firewall logs."""
