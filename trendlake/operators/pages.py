"""Stored page snapshots -> post, profile and edge records.

The collector read these fields from a live page with CSS selectors; here the
same rules run over stored HTML as Spark expressions. A page is parsed once
into its tag stream (``markup``): elements end where their depth returns,
selectors are tests of names, attributes and ancestors, and texts are those of
all descendants, decoded. Every post element (``<article>``, nested ones too)
is a candidate post. Nothing is cut by default; the collector's limits are
parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.text import (clean_bio, clean_username, contains_any, display_name_or_null,
                              handle_from_href, handle_from_text, is_handle_href, nonempty, py_strip)
from ..schemas import (CONTENT_MIN_FALLBACK, POST_ID_ATTRS, POST_ID_MIN_TEXT, POST_ID_TEXT_HASH_LEN,
                       REPOST_CONTEXT_WORDS, REPOST_MARKER_ARIA, REPOST_MARKER_TESTIDS,
                       REPOST_TEXT_PHRASES, STATUS_ID_MIN_DIGITS)
from . import markup
from .markup import attribute, elements, first_text, text_of

POST = "article"        # tag of a post element


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _read(element, rule) -> Column:
    """A rule for parsed documents, applied to markup."""
    return let(markup.parse(_c(element)), rule)


def _testid(x: Column) -> Column:
    return attribute(x, "data-testid")


def _marked(doc: Column, value: str, *names: str) -> Column:
    return elements(doc, *names, where=lambda x: _testid(x) == value)


# Content rules in the order they are tried: the first that finds text wins.
# All elements of a post lie in its <article>, so the rules that ask for such
# an ancestor ask for nothing more. Paragraphs are for pages of other layouts.
CONTENT_RULES = (
    lambda d: _marked(d, "tweetText", "div"),
    lambda d: _marked(d, "tweetText", "span"),
    lambda d: elements(d, "div", where=lambda x: attribute(x, "lang").isNotNull() & _testid(x).isNull()),
    lambda d: elements(d, "div", where=lambda x: attribute(x, "lang").isNotNull()),
    lambda d: elements(d, "div", where=lambda x: (attribute(x, "dir") == "auto") & _testid(x).isNull()),
    lambda d: elements(d, "span", where=lambda x: attribute(x, "lang").isNotNull()),
    lambda d: elements(d, "p"),
)


def page_elements(pages: DataFrame, keep=("page_id",)) -> DataFrame:
    """(keep..., element, tag, html) of every post element of a page, in order
    of their opening tags; a page without one gives a row whose element is NULL
    and html ''."""
    rows = _elements(pages.select(*keep, markup.parse(F.col("html")).alias("_page")), keep)
    return rows.select(*keep, "element", "tag", F.coalesce(markup.written(F.col("doc")), F.lit("")).alias("html"))


def _elements(parsed: DataFrame, keep) -> DataFrame:
    """As page_elements, but parsed: column ``doc``."""
    found = let(F.col("_page"), lambda d: F.transform(elements(d, POST), lambda a: F.struct(
        a["raw"].alias("tag"), markup.inside(d, a).alias("doc"))))
    rows = parsed.select(*keep, F.posexplode_outer(found).alias("element", "_el"))
    return rows.select(*keep, "element", F.coalesce("_el.tag", F.lit("")).alias("tag"), F.col("_el.doc").alias("doc"))


def content_text(element, max_parts: int | None = None, max_fallback: int | None = None) -> Column:
    """Post text: the non-empty texts of the first content rule that has any,
    joined by a space; else the element's whole text if it is longer than 10
    characters; else ''. The limits cut the parts and the fallback."""
    return _read(element, lambda d: _content(d, max_parts, max_fallback))


def _content(d: Column, max_parts: int | None = None, max_fallback: int | None = None) -> Column:
    def chosen(d: Column) -> Column:
        tries = []
        for rule in CONTENT_RULES:
            texts = F.filter(F.transform(rule(d), lambda x: py_strip(text_of(d, x))), lambda t: t != "")
            tries.append(nonempty(F.array_join(texts if max_parts is None else F.slice(texts, 1, max_parts), " ")))
        whole = let(py_strip(text_of(d)), lambda w: F.when(
            F.length(w) > CONTENT_MIN_FALLBACK, w if max_fallback is None else F.substring(w, 1, max_fallback)))
        return F.coalesce(*tries, whole, F.lit(""))

    return let(d, chosen)


def _first_attribute(found: Column, name: str) -> Column:
    """First non-empty value of an attribute among the found elements."""
    values = F.filter(F.transform(found, lambda x: attribute(x, name)), lambda v: v.isNotNull() & (v != ""))
    return F.get(values, F.lit(0))


def date_text(element) -> Column:
    """<time> datetime attribute -> title attribute -> stripped text -> ''."""
    return _read(element, _date)


def _date(d: Column) -> Column:
    times = elements(d, "time")
    return F.coalesce(_first_attribute(times, "datetime"), _first_attribute(times, "title"),
                      py_strip(first_text(d, times)), F.lit(""))


def hrefs(doc: Column) -> Column:
    """Targets of all links, in order."""
    return F.filter(F.transform(elements(doc, "a"), lambda x: attribute(x, "href")), lambda h: h.isNotNull())


def status_id(hrefs) -> Column:
    """First link whose text after the last '/status/' and before the first
    '?' is all digits and at least 11 long; NULL if none."""
    def sid(h):
        return F.substring_index(F.element_at(F.split(h, "/status/"), -1), "?", 1)
    cand = F.filter(_c(hrefs), lambda h: F.instr(h, "/status/") > 0)
    ids = F.filter(F.transform(cand, sid),
                   lambda s: s.rlike(f"^[0-9]{{{STATUS_ID_MIN_DIGITS},}}\\z"))
    return F.try_element_at(ids, F.lit(1))


def post_id(element, open_tag, attrs=POST_ID_ATTRS, html_prefix: int | None = None,
            text_prefix: int | None = None) -> Column:
    """Id cascade: status id -> 'time_'+datetime -> '<attr>_'+value of the
    element's own id attributes -> 'hash_'+md5(inner HTML) ->
    'stable_'+md5(stripped text)[:12] -> NULL. The prefixes cut what is hashed
    (the collector hashed beginnings, so posts that begin alike shared an id);
    an attribute that all posts carry alike is no id and not among ``attrs``.
    An element with text has inner HTML, so the last rule is reached only by
    callers that pass a text without its markup."""
    return _read(element, lambda d: _post_id(d, _c(open_tag), attrs, html_prefix, text_prefix))


def _post_id(d: Column, tag: Column, attrs=POST_ID_ATTRS, html_prefix: int | None = None,
             text_prefix: int | None = None) -> Column:
    def cascade(d: Column) -> Column:
        own = [F.concat(F.lit(a + "_"), nonempty(markup.value_of(markup.attributes(tag), a))) for a in attrs]
        html, text = markup.written(d), py_strip(text_of(d))
        hashed = html if html_prefix is None else F.substring(html, 1, html_prefix)
        stable = text if text_prefix is None else F.substring(text, 1, text_prefix)
        return F.coalesce(
            status_id(hrefs(d)), F.concat(F.lit("time_"), _first_attribute(elements(d, "time"), "datetime")), *own,
            F.when(py_strip(html) != "", F.concat(F.lit("hash_"), F.md5(hashed))),
            F.when(F.length(text) > POST_ID_MIN_TEXT,
                   F.concat(F.lit("stable_"), F.substring(F.md5(stable), 1, POST_ID_TEXT_HASH_LEN))))

    return let(d, cascade)


def repost_flag(text, html=None) -> Column:
    """Repost test: context line has a repost word, or the whole text has a
    repost phrase, or (with HTML) a marker element, any label that says so, or
    a nested post."""
    flag = contains_any(F.lower(_c(text)), REPOST_TEXT_PHRASES)
    return flag if html is None else flag | _read(html, _repost_marks)


def _repost(d: Column) -> Column:
    return repost_flag(text_of(d)) | F.coalesce(_repost_marks(d), F.lit(False))


def _repost_marks(d: Column) -> Column:
    def marks(d: Column) -> Column:
        ctx = F.lower(first_text(d, _marked(d, "socialContext")))
        labels = F.lower(F.array_join(F.transform(d["els"], lambda x: attribute(x, "aria-label")), "\n"))
        return (contains_any(ctx, REPOST_CONTEXT_WORDS) | contains_any(labels, REPOST_MARKER_ARIA)
                | F.exists(d["els"], lambda x: F.coalesce(_testid(x).isin(*REPOST_MARKER_TESTIDS), F.lit(False)))
                | (F.size(_marked(d, "tweet", "div")) > 0))

    return let(d, marks)


def _user(doc: Column) -> Column:
    return handle_from_text(py_strip(first_text(doc, _marked(doc, "User-Name", "div"))))


def quoted_post(element) -> Column:
    """Struct (quoted_username, quoted_content) of the last post nested in an
    element, NULLs without one."""
    return _read(element, _quoted)


def _quoted(d: Column) -> Column:
    last = F.try_element_at(_marked(d, "tweet", "div"), F.lit(-1))
    return let(last, lambda x: let(F.when(x.isNotNull(), markup.inside(d, x)), lambda inner: F.struct(
        _user(inner).alias("quoted_username"), nonempty(_content(inner)).alias("quoted_content"))))


def page_posts(pages: DataFrame) -> DataFrame:
    """One row per post element: (page_id, element, title, heading, content,
    date_text, post_id, is_repost, quoted_username, quoted_content, n_links)."""
    # the elements are cut out once and then read by every field
    parsed = pages.select("page_id", F.explode(F.array(markup.parse(F.col("html")))).alias("_page"))
    d = F.col("_page")
    page = parsed.select("page_id", "_page", py_strip(first_text(d, elements(d, "title"))).alias("title"),
                         py_strip(first_text(d, elements(d, "h1"))).alias("heading"),
                         F.size(hrefs(d)).alias("n_links"))
    el = _elements(page, ("page_id", "title", "heading", "n_links"))
    e = F.col("doc")
    return el.select(
        "page_id", "element", "title", "heading", F.coalesce(_content(e), F.lit("")).alias("content"),
        F.coalesce(_date(e), F.lit("")).alias("date_text"), _post_id(e, F.col("tag")).alias("post_id"),
        _repost(e).alias("is_repost"), _quoted(e).alias("_q"), "n_links",
    ).select("page_id", "element", "title", "heading", "content", "date_text", "post_id", "is_repost",
             "_q.quoted_username", "_q.quoted_content", "n_links")


def page_reposts(pages: DataFrame) -> DataFrame:
    """(page_id, element, retweet_username, retweet_main_content, retweet_date)
    of the post elements that are reposts."""
    el = _elements(pages.select("page_id", markup.parse(F.col("html")).alias("_page")), ("page_id",))
    e = F.col("doc")
    return (el.where(_repost(e))
            .select("page_id", "element", _user(e).alias("retweet_username"),
                    _content(e).alias("retweet_main_content"), _date(e).alias("retweet_date")))


def _links(html: Column) -> Column:
    """Links with a target: array of struct(href, text)."""
    return let(markup.parse(html), lambda d: F.filter(F.transform(elements(d, "a"), lambda a: F.struct(
        attribute(a, "href").alias("href"), py_strip(text_of(d, a)).alias("text"))),
        lambda x: x["href"].isNotNull()))


def page_links(pages: DataFrame, keep=("page_id",)) -> DataFrame:
    """(keep..., pos, href, text) per link, in document order."""
    return (pages.select(*keep, F.posexplode(_links(F.col("html"))).alias("pos", "_a"))
            .select(*keep, "pos", "_a.href", "_a.text"))


# ---- accounts and edges ----------------------------------------------------

def page_accounts(pages: DataFrame) -> DataFrame:
    """Account behind each page: handle from the URL path, its file-safe
    form, and the heading as display name."""
    h = handle_from_href(F.regexp_replace("url", r"^[a-z]+://[^/]*", ""))
    return pages.select("page_id", h.alias("handle"), clean_username(h).alias("file_name"))


def page_edges(pages: DataFrame, max_edges: int | None = None, direction: str = "following") -> DataFrame:
    """Edges from a page's handle links: first link per handle wins, the first
    ``max_edges`` of a page (None: all); display name cleaned and kept only
    when it is not a handle itself. All links of a page stand in one row, so
    deduplication and cap are array functions: no shuffle."""
    known = F.transform(F.filter(_links(F.col("html")), lambda x: is_handle_href(x["href"])), lambda x: F.struct(
        handle_from_href(x["href"]).alias("handle"), x["text"].alias("text")))

    def chosen(found: Column) -> Column:
        # the first place of each distinct handle, in order
        first = let(F.transform(found, lambda x: x["handle"]), lambda handles: F.transform(
            F.array_distinct(handles), lambda h: F.get(found, F.array_position(handles, h).cast("int") - 1)))
        return first if max_edges is None else F.slice(first, 1, max_edges)

    out = pages.select("page_id", F.posexplode(let(known, chosen)).alias("_at", "_e"))
    return out.select("page_id", F.lit(direction).alias("direction"), F.col("_e.handle").alias("handle"),
                      (F.col("_at") + 1).alias("rn"),
                      F.coalesce(display_name_or_null(F.col("_e.text"), F.col("_e.handle")),
                                 F.col("_e.handle")).alias("name"))


def page_bio(html) -> Column:
    """Bio of a profile page: the meta description, cleaned."""
    return clean_bio(F.coalesce(_read(html, lambda d: _first_attribute(elements(
        d, "meta", where=lambda x: F.lower(attribute(x, "name")) == "description"), "content")), F.lit("")))
