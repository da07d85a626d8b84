"""Column functions: every one returns a built-in Spark expression."""

from triage.functions.alerts import (
    alert_message, alert_payload, alert_subject, resolve_recipient, status_label,
)
from triage.functions.classify import classification_text, classify_status, classify_text
from triage.functions.dates import parse_iso, parse_rfc2822
from triage.functions.html import html_to_text
from triage.functions.subject import position_and_company
from triage.functions.text import (
    clean, clean_lower, collapse_ws, company_from_domain, head, is_valid_email,
    normalize_text, py_strip, sender_domain, title_case,
)

__all__ = [
    "alert_message", "alert_payload", "alert_subject", "resolve_recipient", "status_label",
    "classification_text", "classify_status", "classify_text", "parse_iso", "parse_rfc2822",
    "html_to_text", "position_and_company", "clean", "clean_lower", "collapse_ws",
    "company_from_domain", "head", "is_valid_email", "normalize_text", "py_strip",
    "sender_domain", "title_case",
]
