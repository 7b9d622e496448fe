"""Fixed schemas."""

CANONICAL = (
    "event_time timestamp, vendor string, log_type string, user_id string, user_dept string, device_id string, src_ip string, "
    "dest_host string, dest_domain string, url_full string, url_path string, url_query string, http_method string, status_code int, "
    "action string, app_name string, app_category string, content_type string, user_agent string, bytes_sent long, bytes_received long, "
    "raw_event_id string, ingest_file string, ingest_lineage_hash string"
)
COLUMNS = [c.strip().split(" ")[0] for c in CANONICAL.split(",")]
