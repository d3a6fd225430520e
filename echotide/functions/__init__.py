"""Column functions: each takes columns and returns a column, evaluated inside the JVM."""

from .dates import (
    format_dmy,
    format_iso_utc,
    iso_wall_date,
    month,
    parse_date_any,
    parse_dmy,
    parse_epoch_or_iso,
    wall_dmy,
)
from .html import decode_entities, html_to_text, page_title, question_title, script_value, strip_inert
from .links import short_id, unwrap_redirect, url_from
from .numbers import safe_divide, safe_int, star_rating
from .text import (
    any_of,
    clean_ctrl,
    clean_text,
    collapse_ws,
    contains_ci,
    first_nonempty,
    first_present,
    fold,
    is_blank,
    json_field,
    lookup,
    mask_user,
    min_chars,
    null_placeholders,
    trim_all,
    truncate,
)

__all__ = [name for name in dir() if not name.startswith("_")]
