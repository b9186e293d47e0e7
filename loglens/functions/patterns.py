"""Fixed values that define loglens parsing semantics.

These must stay exactly as written: the access-log pattern is the one the
original job parses with, and the remaining rules are this project's
documented definitions (see FIXTURES.md).
"""

# --- fixed values: access-log line patterns -------------------------------
# Extended (combined) access log, seven groups:
#   ip, datetime, request, status, bytes, referrer, user_agent.
# Left-anchored only: trailing text after the user agent is ignored.
EXTENDED_PATTERN = r'(^\S+) - - \[(.*?)\] "(.*?)" (\d{3}) (\d+) "(.*?)" "(.*?)"'
EXTENDED_FIELDS = ("ip", "datetime", "request", "status", "bytes", "referrer", "user_agent")

# Common or extended format, eight groups: any remote user, bytes may be
# "-", referrer and user agent optional.
ANY_PATTERN = r'^(\S+) \S+ (\S+) \[(.*?)\] "(.*?)" (\d{3}) (\d+|-)(?: "(.*?)" "(.*?)")?'
ANY_FIELDS = ("ip", "remote_user", "datetime", "request", "status", "bytes",
              "referrer", "user_agent")

# Request line "METHOD URI PROTOCOL" and the endpoint (URI path, no query).
REQUEST_PATTERN = r'^(\S+) (\S+) (\S+)$'
ENDPOINT_PATTERN = r'^\S+ ([^ ?]+)'

# Access-log time stamp, e.g. 20/Oct/2025:09:13:26 +0700.
ACCESS_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# --- fixed values: severity filter ----------------------------------------
ALERT_LEVELS = ("ERROR", "WARN", "CRITICAL")

# --- fixed values: user-agent rules, first match wins ---------------------
BROWSER_RULES = (
    ("Opera|OPR/", "Opera"),
    ("MSIE|Trident", "Internet Explorer"),
    ("Firefox|FxiOS", "Firefox"),
    ("Chrome|CriOS", "Chrome"),
    ("Safari", "Safari"),
)
BROWSER_OTHER = "Other"
DEVICE_RULES = (
    ("iPad|Tablet", "tablet"),
    ("Mobile|iPhone|Android", "mobile"),
)
DEVICE_EMPTY = "unknown"
DEVICE_OTHER = "desktop"
