"""String column functions (all JVM-side expressions, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.isspace() accepts; Java's \s alone is ASCII-only.
# Patterns anchor the end with \z: Java's $ also matches before a final line
# terminator (\n, \x85, ...), which Python's string rules do not.
_PY_SPACE_SET = r"\t\n\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_PY_SPACE = f"[{_PY_SPACE_SET}]"
_PY_NONSPACE = f"[^{_PY_SPACE_SET}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def space_trim(c) -> Column:
    """SQL trim: cuts spaces only, keeps tabs and newlines."""
    return F.trim(_c(c))


def py_strip(c) -> Column:
    """Python ``str.strip()``: cuts every kind of leading/trailing whitespace."""
    return F.regexp_replace(_c(c), f"^{_PY_SPACE}+|{_PY_SPACE}+\\z", "")


def strip_chars(c, chars: str) -> Column:
    """Python ``str.strip(chars)`` for a set of literal characters."""
    cls = "".join("\\" + ch if ch in r"\^]-[" else ch for ch in chars)
    return F.regexp_replace(_c(c), f"^[{cls}]+|[{cls}]+\\z", "")


def join_non_null(*cols, sep: str = " ") -> Column:
    """Skip-null join; all parts NULL gives ''."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def nonempty(c) -> Column:
    """NULL for NULL or '' (used to build first-non-empty cascades)."""
    c = _c(c)
    return F.when(c != "", c)


def first_nonempty(*cols) -> Column:
    return F.coalesce(*[nonempty(c) for c in cols])


def contains_any(c, needles) -> Column:
    """True when the text contains one of the literal needles (NULL text: False)."""
    c = _c(c)
    out = F.lit(False)
    for n in needles:
        out = out | F.coalesce(F.instr(c, n) > 0, F.lit(False))
    return out


def handle_from_href(href) -> Column:
    """Last path segment after cutting leading/trailing slashes."""
    return F.try_element_at(F.split(strip_chars(href, "/"), "/"), F.lit(-1))


def is_handle_href(href) -> Column:
    """href has a '/', is not a status link, and its last segment is a
    non-empty name not starting with 'http'."""
    href = _c(href)
    h = handle_from_href(href)
    return F.coalesce(
        (F.instr(href, "/") > 0) & (F.instr(href, "/status/") == 0)
        & (h != "") & ~h.startswith("http"),
        F.lit(False),
    )


def handle_from_text(text) -> Column:
    """'@name rest' -> 'name': strip '@' at both ends, first whitespace token.
    NULL when the text has no '@' or no token."""
    text = _c(text)
    tok = F.regexp_extract(strip_chars(text, "@"), rf"^{_PY_SPACE}*({_PY_NONSPACE}+)", 1)
    return F.when((F.instr(text, "@") > 0) & (tok != ""), tok)


def clean_username(c) -> Column:
    """Filesystem-safe account name: '@' dropped; space, '/' and '\\' become '_';
    only letters, digits, '_' and '-' kept."""
    c = F.translate(F.regexp_replace(_c(c), "@", ""), " /\\", "___")
    return F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "")


def clean_bio(c) -> Column:
    """strip -> drop every 'Follow' -> strip."""
    return py_strip(F.replace(py_strip(c), F.lit("Follow"), F.lit("")))


def clean_display_name(c) -> Column:
    """strip -> drop every middle dot -> strip."""
    return py_strip(F.replace(py_strip(c), F.lit("·"), F.lit("")))


def display_name_or_null(name, handle) -> Column:
    """Display name if it is non-blank, does not start with '@' and differs
    from the handle once cleaned; else NULL."""
    name = _c(name)
    cleaned = clean_display_name(name)
    ok = (py_strip(name) != "") & ~name.startswith("@") & (cleaned != _c(handle))
    return F.when(F.coalesce(ok, F.lit(False)), cleaned)


def descriptive_text_or_null(c) -> Column:
    """Fallback bio text: longer than 5, not '@...', without 'Follow'."""
    c = _c(c)
    ok = (F.length(c) > 5) & ~c.startswith("@") & (F.instr(c, "Follow") == 0)
    return F.when(F.coalesce(ok, F.lit(False)), py_strip(c))


def content_key(html, text, n: int = 16) -> Column:
    """Deterministic content key of an element: first ``n`` hex digits of
    md5(html + text) (the reference's variant also mixed in the clock)."""
    return F.substring(F.md5(F.concat(F.coalesce(_c(html), F.lit("")),
                                      F.coalesce(_c(text), F.lit("")))), 1, n)
