"""Settings as plain data. The values here are fixed: results depend on them."""

from __future__ import annotations

# Canonical detection thresholds and groups.
MIB = 1 << 20
WRITE_METHODS = ["POST", "PUT", "PATCH"]
HIGH_RISK_CATEGORIES = ["GenAI", "AI", "Unknown", "Uncategorized"]
DETECT = {"a_bytes": MIB, "burst_n": 20, "window_s": 300, "cum_bytes": 20 * MIB, "rate": 0.02}
METHOD_GROUPS = {"GET": ["GET", "HEAD", "OPTIONS"], "WRITE": ["POST", "PUT", "PATCH", "DELETE"]}
#: Name and largest size of each bytes bucket.
BYTES_BUCKETS = [("T", 1023), ("L", MIB - 1), ("M", 10 * MIB - 1), ("H", 1024 * MIB - 1), ("X", (1 << 63) - 1)]

# URL normalisation.
SIGNATURE_VERSION = "1.0"
DROP_KEYS = ["gclid", "dclid", "fbclid", "msclkid", "ttclid", "twclid", "igshid", "mc_cid", "mc_eid", "yclid", "_ga", "_gl", "ref", "referrer", "session", "sid", "phpsessid", "srsltid", "spm", "utm_id"]
DROP_PREFIXES = ["utm_"]
#: Type, pattern and replacement, applied in this order.
REDACTIONS = [
    ("uuid", r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b", ":uuid"),
    ("hex", r"(?i)\b[0-9a-f]{16,}\b", ":hex"),
    ("tok", r"\b[A-Za-z0-9_-]{20,}\b", ":tok"),
    ("email", r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", ":email"),
    ("ip", r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b", ":ip"),
    ("id", r"\b[0-9]{6,}\b", ":id"),
]
SENSITIVE = "(?i)(password|token|apikey|authorization)="
AUTH_WORDS = "(?i)token|auth|key|secret|session|jwt"

# Taxonomy dimensions, the least and the largest number of codes of each.
DIMENSIONS = {"FS": (1, 1), "UC": (1, None), "DT": (1, None), "CH": (1, None), "IM": (1, 1), "RS": (1, None), "OB": (0, None), "LG": (1, None)}

# Prices a user and month, and an access; and what savings assume.
PRICES = [("ChatGPT", 20.0, 0.0), ("Claude", 20.0, 0.0), ("Gemini", 0.0, 0.0), ("Copilot", 30.0, 0.0), ("DeepL", 6.99, 0.0), ("Grammarly", 12.0, 0.0), ("Hugging Face", 0.0, 0.001), ("Replicate", 0.0, 0.01)]
DEFAULT_PRICE = (15.0, 0.0)
SAVINGS = {"duplicate": 0.3, "dormant": 0.2, "consolidation": 0.25, "dormant_accesses": 5, "department_users": 10}

# Errors of the outside classifier.
PERMANENT_ERRORS = ["invalid_request_error", "context_length_exceeded", "invalid_api_key", "authentication_error"]
TRANSIENT_ERRORS = ["rate_limit_error", "timeout", "network_error", "server_error"]

# For each vendor the columns that may hold a canonical field, best first.
VENDORS: dict[str, dict] = {}
VENDORS["paloalto"] = {
    "log_type": "firewall", "tz": "UTC", "time": ["start", "receive_time", "generated_time"], "url": ["url", "request_url", "http_url"],
    "sent": ["bytes_sent"], "received": ["bytes_received"], "action": ["action"],
    "allow": ["allow", "alert", "continue"], "block": ["deny", "drop", "reset-client", "reset-server", "reset-both", "block-url"],
    "user": ["srcuser", "user", "username"], "src_ip": ["src", "src_ip"], "method": ["http_method", "method"], "app": ["app", "application"], "category": ["url_category", "category"],
}
VENDORS["zscaler"] = {
    "log_type": "web", "tz": "UTC", "time": ["datetime", "date", "time"], "url": ["url"],
    "sent": ["reqsize", "bytes_sent", "sent_bytes", "upload", "tx"], "received": ["respsize", "bytes_received", "recv_bytes", "download", "rx"], "action": ["action"],
    "allow": ["allowed", "allow", "permitted", "pass", "Allowed"], "block": ["blocked", "block", "denied", "deny", "Blocked"],
    "user": ["user", "login", "username"], "src_ip": ["cip", "srcip", "clientip", "client_ip"], "method": ["requestmethod", "method"], "app": ["appname", "application"], "category": ["urlcategory", "category", "urlclass"],
}
VENDORS["netskope"] = {
    "log_type": "web", "tz": "UTC", "time": ["timestamp", "event_timestamp", "date", "time"], "url": ["url", "cs-uri", "request", "dst_url"],
    "sent": ["cs-bytes", "clientBytes", "bytes_sent", "upload", "sent_bytes"], "received": ["sc-bytes", "serverBytes", "bytes_received", "download", "recv_bytes"], "action": ["action", "cs-activity", "eventType", "activity"],
    "allow": ["allowed", "allow", "permitted", "pass", "success", "Allowed"], "block": ["blocked", "block", "denied", "deny", "policy_denied", "Blocked"],
    "user": ["user", "cs-username", "srcuser", "userPrincipalName"], "src_ip": ["c-ip", "srcip", "client_ip", "src_ip"], "method": ["cs-method", "method", "request_method"], "app": ["app", "application", "appName"], "category": ["category", "app_category", "urlCategory"], "device": ["device", "device_name", "hostname"],
}
VENDORS["mdca"] = {
    "log_type": "cloudapp", "tz": "UTC", "time": ["Timestamp", "timestamp", "EventTime", "event_time", "createdDateTime"], "url": ["Url", "ObjectId", "Resource", "targetResource", "url"], "action": ["ActionType", "action", "Activity", "eventType"],
    "allow": ["Allowed", "Success", "Succeeded", "success", "allow"], "block": ["Blocked", "Denied", "Failed", "blocked", "deny"],
    "user": ["User", "UserId", "Account", "userPrincipalName", "user"], "src_ip": ["IpAddress", "IP", "SourceIP", "clientIP", "ip_address"], "app": ["AppName", "appDisplayName", "application", "app"], "category": ["Category", "appCategory", "category"], "device": ["DeviceName", "device", "machineName"],
}
VENDORS["umbrella"] = {
    "log_type": "web", "tz": "UTC", "time": ["timestamp", "datetime", "time", "Timestamp"], "url": ["url", "destination", "request_url", "URL", "Destination URL"],
    "sent": ["request_size", "bytes_sent", "tx", "requestSize"], "received": ["response_size", "bytes_received", "rx", "responseSize"], "action": ["action", "verdict", "policy_action", "Action"],
    "allow": ["Allowed", "ALLOW", "1", "allowed", "Proxied"], "block": ["Blocked", "BLOCK", "0", "blocked", "Denied"],
    "user": ["identity", "user", "Identity", "internalIp"], "src_ip": ["internalIp", "Internal IP", "srcip", "src_ip"], "category": ["categories", "Category", "category"],
}
VENDORS["bluecoat"] = {
    "log_type": "proxy", "tz": "UTC", "time": ["date", "time", "timestamp", "x-timestamp"], "url": ["cs-uri", "cs-uri-stem", "cs_uri", "url"],
    "sent": ["cs-bytes", "bytes_sent", "upload", "sc-bytes"], "received": ["sc-bytes", "bytes_received", "download", "rs-bytes"], "action": ["x-exception-id", "action", "s-action", "sc-filter-result"],
    "allow": ["-", "Allowed", "allow", "OBSERVED", "PROXIED"], "block": ["blocked", "deny", "exception", "policy_denied", "DENIED", "TCP_DENIED"],
    "user": ["cs-username", "cs-auth-user", "user", "cs-userdn"], "src_ip": ["c-ip", "cs-ip", "client_ip"], "method": ["cs-method", "method"], "status": ["sc-status", "status", "rs-status"], "category": ["cs-categories", "x-category", "category"], "user_agent": ["cs(User-Agent)", "cs-user-agent", "user_agent"],
}
VENDORS["skyhigh"] = {
    "log_type": "web", "tz": "UTC", "time": ["timestamp", "date", "time", "DateTime", "eventTime"], "url": ["url", "cs-uri", "request_url", "URL", "destination"],
    "sent": ["bytes_sent", "upload", "tx", "reqsize", "request_size"], "received": ["bytes_received", "download", "rx", "respsize", "response_size"], "action": ["action", "verdict", "result", "block_reason"],
    "allow": ["allowed", "permit", "pass", "Allow", "ALLOW"], "block": ["blocked", "deny", "Block", "BLOCK", "DROP"],
    "user": ["user", "username", "user_id", "client_user"], "src_ip": ["client_ip", "src_ip", "source_ip", "srcip"], "method": ["method", "http_method", "request_method"], "status": ["status_code", "http_status", "response_code"], "category": ["category", "url_category", "web_category"], "app": ["application", "app_name", "app"],
}
VENDORS["ifilter"] = {
    "log_type": "web", "tz": "Asia/Tokyo", "time": ["date", "time", "timestamp", "日時", "アクセス日時"], "url": ["url", "request_url", "URL", "アクセス先URL"],
    "sent": ["bytes_sent", "upload", "reqsize", "送信バイト数"], "received": ["bytes_received", "download", "respsize", "受信バイト数"], "action": ["action", "result", "judgement", "判定結果", "アクション"],
    "allow": ["ALLOW", "OK", "PERMIT", "許可", "通過"], "block": ["BLOCK", "NG", "DENY", "規制", "ブロック"],
    "user": ["user", "username", "ユーザ名", "ユーザID", "user_id"], "src_ip": ["client_ip", "src_ip", "クライアントIP", "送信元IP"], "method": ["method", "http_method", "メソッド"], "status": ["status", "status_code", "ステータスコード"], "category": ["category", "カテゴリ", "カテゴリ名", "規制カテゴリ"],
}

#: Public suffixes for a first use; a full list is read from a path. `*.x` and `!y.x` as in the public list.
SUFFIXES = ["com", "net", "org", "jp", "co.jp", "uk", "co.uk", "*.ck", "!www.ck"]
