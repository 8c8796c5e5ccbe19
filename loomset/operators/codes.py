"""Error codes of rows that cannot be used, in the order they are tested."""

BAD_JSON = "BAD_JSON"
NOT_A_MAPPING = "NOT_A_MAPPING"
ROW_TOO_LARGE = "ROW_TOO_LARGE"
PREF_MISSING_FIELDS = "PREF_MISSING_FIELDS"
MESSAGES_EMPTY = "MESSAGES_EMPTY"
MESSAGE_KEYS = "MESSAGE_KEYS"
INVALID_ROLE = "INVALID_ROLE"
MISSING_RESPONSE = "MISSING_RESPONSE"
UNKNOWN_SCHEMA = "UNKNOWN_SCHEMA"
CORPUS_TEXT = "CORPUS_TEXT"
NULL_FIELD = "NULL_FIELD"
TEMPLATE_FAILED = "TEMPLATE_FAILED"
