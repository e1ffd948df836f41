"""Column functions of the engine, by topic: numbers and signs, periods and dates, texts, hashes."""

from ..operators.corpus import content_kind, exit_class, metadata_fingerprint, redact
from ..operators.detect import content_address, is_new, is_revision
from ..operators.extract import period_title, period_url, rejoin_digits
from ..operators.pages import attribute, html_to_text, release_date, release_kind, stale, tokens, unescape, url_join
from ..operators.statements import number, signed
from ..operators.gates import is_object, unfence
from ..operators.ledger import content_id, payload_hash
from ..operators.readings import shown_pct, shown_value
from ..operators.series import pct_change
from ..operators.transcripts import fold, strip_markup

__all__ = [
    "content_address", "content_id", "content_kind", "exit_class", "fold", "html_to_text", "is_new", "is_object", "is_revision", "metadata_fingerprint", "number", "payload_hash", "pct_change", "period_title", "period_url", "redact",
    "rejoin_digits", "release_date", "release_kind", "shown_pct", "shown_value", "signed", "stale", "strip_markup", "unfence",
]
