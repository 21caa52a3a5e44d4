"""Column expressions shared by the operators."""

from tabsync.functions.compare import (canonical, change_list, comparable, differs, exact_bytes, fingerprint_label,
                                       value_text)
from tabsync.functions.text import (EMAIL_PATTERN, ID_PATTERN, backfill_key, csv_boolean, display_name,
                                    has_key, is_blank, is_email, looks_like_id, mask_email, not_blank,
                                    trimmed)

__all__ = [
    "EMAIL_PATTERN", "ID_PATTERN", "backfill_key", "canonical", "change_list", "comparable",
    "csv_boolean", "differs", "display_name", "exact_bytes", "fingerprint_label", "has_key", "is_blank", "is_email",
    "looks_like_id", "mask_email", "not_blank", "trimmed", "value_text",
]
