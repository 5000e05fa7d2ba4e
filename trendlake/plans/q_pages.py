"""Page-extraction, id-cascade, handle and repost queries over stored pages,
and over post elements rendered from conversations.

The SQL states its own patterns and expected values: it imports no rule from
the operators. For the rendered elements it does not parse anything; it names
the values that the elements were rendered from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import (content_key, descriptive_text_or_null, handle_from_text)
from ..operators import feeds
from ..operators import pages as pg
from . import fixtures as fx
from .registry import register

PAGE_MAX_EDGES = 4

# ---- the stored pages: cut at '<' and numbered, for DuckDB ---------------------
_EDGE_SPACE = r"^[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+|[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+$"


def _stripped(x):
    return f"regexp_replace({x}, '{_EDGE_SPACE}', '', 'g')"


def _decoded(x):
    """The references that occur in the table's titles, headings and texts."""
    return f"regexp_replace(replace({x}, '&quot;', chr(34)), '&amp;?', '&', 'g')"


def _bare(x):
    """Text of markup, without space at the ends."""
    return _stripped(_decoded(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))


# What follows each '<' of an element is a tag and the text after it. Every
# opening or closing paragraph tag begins a new run of pieces.
_ELEMENTS = """
cut AS (SELECT page_id, html AS page, string_split(html, '<article') AS parts FROM pages),
el AS (SELECT page_id, page, unnest(range(len(parts) - 1)) AS element, unnest(parts[2:]) AS part FROM cut),
inner_ AS (SELECT page_id, page, element, string_split(substr(part, strpos(part, '>') + 1), '</article>')[1] AS h FROM el),
pieces AS (SELECT page_id, element, unnest(range(len(string_split(h, '<')))) AS i, unnest(string_split(h, '<')) AS piece
  FROM inner_),
told AS (SELECT *, lower(regexp_extract(piece, '^/?[A-Za-z0-9]+')) AS name, substr(piece, strpos(piece, '>') + 1) AS said
  FROM pieces WHERE i > 0),
runs AS (SELECT *, sum(CASE WHEN name IN ('p', '/p') THEN 1 ELSE 0 END) OVER (PARTITION BY page_id, element ORDER BY i) AS run
  FROM told),
paragraphs AS (SELECT page_id, element, run, arg_min(name, i) AS began, string_agg(said, '' ORDER BY i) AS said
  FROM runs GROUP BY ALL)"""


@register("page_extract", f"""
WITH {_ELEMENTS},
texts AS (SELECT page_id, element, string_agg(said, ' ' ORDER BY run) AS said FROM (
  SELECT page_id, element, run, {_stripped(_decoded('said'))} AS said FROM paragraphs WHERE began = 'p')
  WHERE said <> '' GROUP BY ALL)
SELECT page_id, CAST(element AS INTEGER) AS element,
  {_bare("string_split(string_split(page, '<title>')[2], '</title>')[1]")} AS title,
  {_bare("string_split(string_split(page, '<h1>')[2], '</h1>')[1]")} AS heading,
  coalesce(t.said, CASE WHEN length({_bare('h')}) > 10 THEN {_bare('h')} ELSE '' END) AS content,
  'hash_' || md5(h) AS post_id,
  CAST(len(string_split(page, 'href="')) - 1 AS INTEGER) AS n_links
FROM inner_ LEFT JOIN texts t USING (page_id, element)
""", "UDF4 SRC10 FN20 FN14 FLT9")
def page_extract(spark, sf_dir):
    posts = pg.page_posts(fx.table(spark, sf_dir, "pages")).where("element IS NOT NULL")
    return posts.select("page_id", "element", "title", "heading", "content", "post_id", "n_links")


# ---- elements rendered from conversations: a branch of every rule per variant ---
VARIANTS = 10


def rendered_pages(conv):
    """Each conversation as a page of post elements, one per turn. What the
    element carries goes by (7 * conv_id + turn) mod 10; the values come from
    the row."""
    v = (F.col("conv_id") * 7 + F.col("turn")) % VARIANTS
    at = F.format_string("2024-01-%02dT%02d:00:00Z", (F.col("conv_id") % 28 + 1).cast("int"), (F.col("turn") % 24).cast("int"))
    number = F.format_string("%012d", F.col("conv_id") * 1000 + F.col("turn"))
    body = F.regexp_replace(F.coalesce("text", F.lit("")), "[<>]", " ")
    user = F.concat(F.lit("user"), (F.col("conv_id") % 50).cast("string"))
    name = F.concat(F.lit('<div data-testid="User-Name">@'), user, F.lit(" and more</div>"))
    nested = F.concat(F.lit('<div data-testid="tweet"></div><div data-testid="tweet"><div data-testid="User-Name">@quoted'),
                      number, F.lit('</div><p>A <i>quoted</i> post</p></div>'))
    carried = (F.when(v == 0, F.concat(F.lit('<a href="/'), user, F.lit("/status/"), number, F.lit('?s=20">x</a>')))
               .when(v == 1, F.concat(F.lit('<time datetime="'), at, F.lit('">then</time>')))
               .when(v == 2, F.concat(F.lit('<time title="'), at, F.lit('">then</time>')))
               .when(v == 3, F.concat(F.lit("<time> "), at, F.lit(" </time>")))
               .when(v == 4, F.lit('<div data-testid="socialContext">Someone reposted</div>'))
               .when(v == 5, F.lit('<i aria-label="Like"></i><i aria-label="12 Reposts"></i>'))
               .when(v == 6, nested)
               .when(v == 7, F.lit('<a href="/someone/status/12">short</a>'))
               .otherwise(F.lit("")))
    attribute = (F.when(v == 2, F.concat(F.lit(' data-tweet-id="'), number, F.lit('"')))
                 .when(v == 3, F.concat(F.lit(' data-item-id="'), number, F.lit('"')))
                 .otherwise(F.lit(' data-testid="tweet"')))
    text = (F.when(v == 8, F.concat(F.lit("<div lang=\"en\">First <b>part</b> of "), number, F.lit("</div><p>left out</p>")))
            .when(v == 9, F.concat(F.lit("bare text of "), number))
            .otherwise(F.concat(F.lit("<p>Turn <b>"), number, F.lit("</b> of it</p><p></p><p>"), body, F.lit("</p>"))))
    element = F.concat(F.lit("<article"), attribute, F.lit(">"), F.when(v == 6, F.lit("")).otherwise(name),
                       carried, F.when(v == 6, F.lit("")).otherwise(text), F.lit("</article>"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", element.alias("e"))))
    return (conv.groupBy(F.col("conv_id").alias("page_id"))
            .agg(F.array_join(F.transform(ordered, lambda x: x["e"]), "\n").alias("html")))


_RENDERED_SQL = f"""
r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS element,
  (conv_id * 7 + turn) % {VARIANTS} AS v, printf('%012d', conv_id * 1000 + turn) AS number,
  printf('2024-01-%02dT%02d:00:00Z', conv_id % 28 + 1, turn % 24) AS at_, 'user' || (conv_id % 50) AS u,
  regexp_replace(coalesce(text, ''), '[<>]', ' ', 'g') AS body FROM conversations),
c AS (SELECT *, CASE v WHEN 6 THEN 'A quoted post' WHEN 8 THEN 'First part of ' || number
    WHEN 9 THEN NULL
    ELSE 'Turn ' || number || ' of it' || CASE WHEN {_bare('body')} <> '' THEN ' ' || {_bare('body')} ELSE '' END END AS said,
  CASE WHEN v IN (1, 2, 3) THEN at_ ELSE '' END AS told FROM r)"""


@register("rendered_posts", f"""
WITH {_RENDERED_SQL}
SELECT conv_id AS page_id, CAST(element AS INTEGER) AS element,
  coalesce(said, '@' || u || ' and morebare text of ' || number) AS content, told AS date_text,
  CASE v WHEN 0 THEN number WHEN 1 THEN 'time_' || at_ WHEN 2 THEN 'data-tweet-id_' || number
    WHEN 3 THEN 'data-item-id_' || number ELSE 'hash' END AS post_id,
  v IN (4, 5, 6) AS is_repost,
  CASE WHEN v = 6 THEN 'quoted' || number END AS quoted_username,
  CASE WHEN v = 6 THEN 'A quoted post' END AS quoted_content
FROM c
""", "UDF4 SRC10 FN15 FN20 FN21 FLT10 FLT12 PRJ17")
def rendered_posts(spark, sf_dir):
    posts = pg.page_posts(rendered_pages(fx.table(spark, sf_dir, "conversations")))
    short = F.when(F.col("post_id").startswith("hash_"), F.lit("hash")).otherwise(F.col("post_id"))
    return posts.select("page_id", "element", "content", "date_text", short.alias("post_id"), "is_repost",
                        "quoted_username", "quoted_content")


@register("rendered_reposts", f"""
WITH {_RENDERED_SQL}
SELECT conv_id AS page_id, CAST(element AS INTEGER) AS element,
  CASE WHEN v = 6 THEN 'quoted' || number ELSE u END AS retweet_username,
  said AS retweet_main_content, told AS retweet_date
FROM c WHERE v IN (4, 5, 6)
""", "FN17 FLT10 reposts of pages")
def rendered_reposts(spark, sf_dir):
    return pg.page_reposts(rendered_pages(fx.table(spark, sf_dir, "conversations")))


@register("post_id_cascade", f"""
WITH {_RENDERED_SQL}
SELECT CASE v WHEN 0 THEN number WHEN 1 THEN 'time_' || at_ WHEN 2 THEN 'data-tweet-id_' || number
    WHEN 3 THEN 'data-item-id_' || number ELSE 'hash_' END AS post_id, count(*) AS n
FROM c GROUP BY 1
""", "FN14 FN15 FLT12 Q20")
def post_id_cascade(spark, sf_dir):
    el = pg.page_elements(rendered_pages(fx.table(spark, sf_dir, "conversations")))
    i = pg.post_id(F.col("html"), F.col("tag"))
    return (el.select(F.when(i.startswith("hash_"), F.lit("hash_")).otherwise(i).alias("post_id"))
            .groupBy("post_id").agg(F.count(F.lit(1)).alias("n")))


# ---- markup that only its depths tell apart --------------------------------------
def nested_pages(conv):
    """Each turn as a page of its own, with nested, unclosed, upper-case or
    otherwise quoted markup, and its text escaped. By (conv_id + turn) mod 6."""
    number = F.format_string("%012d", F.col("conv_id") * 1000 + F.col("turn"))
    body = F.coalesce("text", F.lit(""))
    for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"), ("'", "&#x27;"), ("é", "&eacute;")):
        body = F.replace(body, F.lit(char), F.lit(reference))

    def page(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    v = (F.col("conv_id") + F.col("turn")) % 6
    html = (F.when(v == 0, page('<article><div data-testid="tweetText">A <div>B ', number, '<div> C</div></div> ', body,
                                "</div><i>left out</i><div class=x data-testid='tweetText'> E </div></article>"))
            .when(v == 1, page("<ARTICLE><DIV LANG=en>Say <I>", number, "</I> ", body, "</DIV><A HREF='/u/status/", number,
                               "?a=1&amp;b=2'>x</A></ARTICLE>"))
            .when(v == 2, page('<article data-item-id="', number, '"><p>Outer ', body, '</p><article data-item-id="in', number,
                               '"><p>Inner ', number, "</p></article><p>after</p></article>"))
            .when(v == 3, page("<article><div dir=auto>Open ", number, " <b>bold<span>deep ", body,
                               "</div></article><p>outside</p>"))
            .when(v == 4, page("<article><p>R&ampD ", number, "<p>", body, "<p>&euro;&#8364;&nbsp;</article>"))
            .otherwise(page('<article><!-- <div lang="x">no</div> --><script>var a = "<p>no</p>";</script>',
                            '<span title="a > b" lang="fr">', body, " <br>", number, "</span><time datetime='at ", number,
                            "'></time></article>")))
    return conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("page_id"), html.alias("html"))


@register("nested_posts", f"""
WITH r AS (SELECT conv_id * 1000 + turn AS page_id, (conv_id + turn) % 6 AS v, coalesce(text, '') AS t,
  printf('%012d', conv_id * 1000 + turn) AS n FROM conversations),
s AS (
  SELECT page_id, 0 AS element, 'A B ' || n || ' C ' || t || ' E' AS content, '' AS date_text, 'hash' AS post_id FROM r WHERE v = 0
  UNION ALL SELECT page_id, 0, 'Say ' || n || ' ' || t, '', n FROM r WHERE v = 1
  UNION ALL SELECT page_id, 0, {_stripped("'Outer ' || t")} || ' Inner ' || n || ' after', '', 'data-item-id_' || n FROM r WHERE v = 2
  UNION ALL SELECT page_id, 1, 'Inner ' || n, '', 'data-item-id_in' || n FROM r WHERE v = 2
  UNION ALL SELECT page_id, 0, 'Open ' || n || ' bolddeep ' || t, '', 'hash' FROM r WHERE v = 3
  UNION ALL SELECT page_id, 0, 'R&D ' || n || CASE WHEN {_stripped('t')} = '' THEN '' ELSE ' ' || {_stripped('t')} END || ' €€', '',
    'hash' FROM r WHERE v = 4
  UNION ALL SELECT page_id, 0, t || ' ' || n, 'at ' || n, 'time_at ' || n FROM r WHERE v = 5)
SELECT page_id, CAST(element AS INTEGER) AS element, {_stripped('content')} AS content, date_text, post_id FROM s
""", "UDF4 SRC10 FN20 FN21 FN14 nested markup")
def nested_posts(spark, sf_dir):
    posts = pg.page_posts(nested_pages(fx.table(spark, sf_dir, "conversations")))
    short = F.when(F.col("post_id").startswith("hash_"), F.lit("hash")).otherwise(F.col("post_id"))
    return posts.select("page_id", "element", "content", "date_text", short.alias("post_id"))


@register("repost_flag", """
SELECT conv_id, turn, turn % 3 = 1 AS is_repost FROM conversations
""", "FLT10 FN22")
def repost_flag(spark, sf_dir):
    """Plain texts, every third of which says that it is a repost."""
    c = fx.table(spark, sf_dir, "conversations")
    said = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("turn") % 3 == 1, F.lit(" She RETWEETED this")).otherwise(F.lit("")))
    return c.select("conv_id", "turn", pg.repost_flag(said).alias("is_repost"))


@register("text_helpers", """
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'name' || conv_id END AS handle,
  CASE WHEN turn % 3 = 0 THEN 'A line about ' || conv_id END AS described,
  substr(md5('<b>' || conv_id || '</b>' || turn), 1, 16) AS key
FROM conversations
""", "FN17 FN19 FN23 FLT15")
def text_helpers(spark, sf_dir):
    c = fx.table(spark, sf_dir, "conversations")
    number = F.col("conv_id").cast("string")
    mention = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("@name"), number, F.lit("\t rest"))).otherwise(number)
    about = (F.when(F.col("turn") % 3 == 0, F.concat(F.lit(" A line about "), number, F.lit(" ")))
             .when(F.col("turn") % 3 == 1, F.lit("Follow me")).otherwise(F.lit("@me")))
    return c.select("conv_id", "turn", handle_from_text(mention).alias("handle"),
                    descriptive_text_or_null(about).alias("described"),
                    content_key(F.concat(F.lit("<b>"), number, F.lit("</b>")), F.col("turn").cast("string")).alias("key"))


_PATH = "regexp_replace(url, '^[a-z]+://[^/]*', '')"
_HANDLE = f"string_split(trim({_PATH}, '/'), '/')[-1]"


@register("clean_handles", f"""
SELECT page_id, {_HANDLE} AS handle,
  regexp_replace(translate(replace({_HANDLE}, '@', ''), ' /\\', '___'), '[^\\p{{L}}\\p{{N}}_-]', '', 'g') AS file_name
FROM pages
""".replace("\\\\", "\\"), "FN16 FN18")
def clean_handles(spark, sf_dir):
    return pg.page_accounts(fx.table(spark, sf_dir, "pages"))


_EDGES = f"""
a AS (SELECT page_id, unnest(ls) AS a, unnest(range(len(ls))) AS pos FROM (
  SELECT page_id, regexp_extract_all(html, '(?s)<a [^>]*href="[^"]*"[^>]*>.*?</a>', 0) AS ls FROM pages)),
l AS (SELECT page_id, pos, regexp_extract(a, 'href="([^"]*)"', 1) AS href, {_bare('a')} AS text FROM a),
h AS (SELECT page_id, pos, text, string_split(trim(href, '/'), '/')[-1] AS handle FROM l
  WHERE contains(href, '/') AND NOT contains(href, '/status/')),
d AS (SELECT page_id, handle, min(pos) AS pos, arg_min(text, pos) AS text FROM h
  WHERE handle <> '' AND NOT starts_with(handle, 'http') GROUP BY ALL),
n AS (SELECT *, rank() OVER (PARTITION BY page_id ORDER BY pos) AS rn,
  trim(replace(text, '·', '')) AS shown FROM d)
SELECT page_id, 'following' AS direction, handle, CAST(rn AS INTEGER) AS rn,
  CASE WHEN text = '' OR starts_with(text, '@') OR shown = handle THEN handle ELSE shown END AS name
FROM n"""


@register("page_edges", f"WITH {_EDGES} WHERE rn <= {PAGE_MAX_EDGES}", "WIN7 FLT13 FN16 FN19")
def page_edges(spark, sf_dir):
    return pg.page_edges(fx.table(spark, sf_dir, "pages"), PAGE_MAX_EDGES)


@register("page_edges_all", f"WITH {_EDGES}", "FLT13 FN16")
def page_edges_all(spark, sf_dir):
    return pg.page_edges(fx.table(spark, sf_dir, "pages"))


@register("named_edges", """
SELECT conv_id AS page_id, role || conv_id AS handle,
  CASE WHEN min(turn) % 3 = 2 THEN 'A ' || role || ' ' || conv_id ELSE role || conv_id END AS name
FROM conversations WHERE role IS NOT NULL GROUP BY conv_id, role
""", "FLT14 FN19")
def named_edges(spark, sf_dir):
    """Links rendered with a display name, with the handle, or with '@...'."""
    c = fx.table(spark, sf_dir, "conversations").where("role IS NOT NULL")
    handle = F.concat("role", F.col("conv_id").cast("string"))
    shown = (F.when(F.col("turn") % 3 == 0, F.concat(F.lit("@"), handle))
             .when(F.col("turn") % 3 == 1, F.concat(F.lit(" · "), handle))
             .otherwise(F.concat(F.lit("A "), F.col("role"), F.lit(" "), F.col("conv_id").cast("string"), F.lit(" ·"))))
    link = F.concat(F.lit('<a class="n" href="/'), handle, F.lit('">'), shown, F.lit("</a>"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", link.alias("l"))))
    page = c.groupBy(F.col("conv_id").alias("page_id")).agg(F.array_join(F.transform(ordered, lambda x: x["l"]), "").alias("html"))
    return pg.page_edges(page).select("page_id", "handle", "name")


@register("page_dedupe", """
WITH seen AS (SELECT page_id AS pos, html FROM pages
  UNION ALL SELECT page_id + 1, html FROM pages WHERE page_id % 2 = 0
  UNION ALL SELECT page_id, html FROM pages WHERE page_id % 5 = 0
  UNION ALL SELECT page_id - 3, html FROM pages WHERE page_id % 7 = 0)
SELECT min(pos) AS pos, md5(html) AS content FROM seen GROUP BY html
""", "WIN8")
def page_dedupe(spark, sf_dir):
    """First place of every markup. The stored pages are seen again at the
    place of the next page, at their own or at an earlier one."""
    p = fx.table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), "html")
    again = [p.where(F.col("pos") % n == 0).select((F.col("pos") + step).alias("pos"), "html")
             for n, step in ((2, 1), (5, 0), (7, -3))]
    seen = p.union(again[0]).union(again[1]).union(again[2])
    return feeds.dedupe_by_content(seen, pos="pos").select("pos", F.md5("html").alias("content"))
