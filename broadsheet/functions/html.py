"""TX3-TX10: page extraction with Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import strip, text
from .text import strip_html
from .urls import clean_image_url, path_of

_LD_BLOCK = r"(?i)<script\b[^>]*type=[\"']application/ld\+json[\"'][^>]*>([\s\S]*?)</script>"
_ATTRIBUTE = r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"


def _scope(html: Column, tag: str) -> Column:
    return F.regexp_extract(html, rf"(?i)<{tag}[^>]*>([\s\S]*?)</{tag}>", 1)


def body_paragraphs(fragment: Column) -> Column:
    """Paragraph texts of a fragment that are long enough to be prose."""
    found = F.regexp_extract_all(fragment, F.lit(r"(?i)<p[^>]*>([\s\S]*?)</p>"), F.lit(1))
    return F.filter(F.transform(found, strip_html), lambda p: F.length(p) > 60)


def extract_body(html: Column, accept: int = 800, max_chars: int | None = None) -> Column:
    """TX3. Narrowest scope with enough prose, else the longest; null when it stays at 400 or less, shortened on demand."""
    article, main = body_paragraphs(_scope(html, "article")), body_paragraphs(_scope(html, "main"))

    def pick(first: Column) -> Column:
        sized = F.transform(
            F.array(first, main, body_paragraphs(html)),
            lambda s, i: F.struct(F.length(F.array_join(s, "")).alias("n"), (-i).alias("rank"), s.alias("parts")),
        )
        enough = F.filter(sized, lambda s: s["n"] >= accept)
        return F.when(F.size(enough) > 0, F.get(enough, F.lit(0))["parts"]).otherwise(F.array_max(sized)["parts"])

    # The lambda binds the article scope, so that it is read once and the wider scopes only when it is too short.
    bound = F.transform(F.array(article), lambda a: F.when(F.length(F.array_join(a, "")) >= accept, a).otherwise(pick(a)))
    body = F.array_join(F.get(bound, F.lit(0)), "\n")
    body = body if max_chars is None else F.substring(body, 1, max_chars)
    return F.when(F.length(body) > 400, body)


def tag_attributes(html: Column, tag: str) -> Column:
    """Every ``<tag ...>`` as a map of its attributes, so that attribute order does not matter."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?i)<{tag}\b[^>]*>"), F.lit(0))

    def attributes(t: Column) -> Column:
        names = F.transform(F.regexp_extract_all(t, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
        double = F.regexp_extract_all(t, F.lit(_ATTRIBUTE), F.lit(2))
        single = F.regexp_extract_all(t, F.lit(_ATTRIBUTE), F.lit(3))
        values = F.zip_with(double, single, lambda d, s: F.concat(d, s))
        pairs = F.zip_with(names, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
        # The last value of a repeated attribute wins.
        return F.aggregate(
            pairs,
            F.create_map().cast("map<string,string>"),
            lambda acc, p: F.map_concat(F.map_filter(acc, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])),
        )

    return F.transform(tags, attributes)


def _first_or_empty(items: Column) -> Column:
    return F.coalesce(strip(F.try_element_at(items, F.lit(1))), F.lit(""))


def meta_content(metas: Column, key: str, value: str) -> Column:
    hits = F.filter(metas, lambda m: m[key] == value)
    return _first_or_empty(F.transform(hits, lambda m: F.coalesce(m["content"], F.lit(""))))


def canonical_url(links: Column) -> Column:
    hits = F.filter(links, lambda m: F.array_contains(F.split(F.lower(F.coalesce(m["rel"], F.lit(""))), r"\s+"), "canonical"))
    return _first_or_empty(F.transform(hits, lambda m: F.coalesce(m["href"], F.lit(""))))


def page_title(html: Column) -> Column:
    return strip(F.regexp_extract(html, r"(?i)<title>([\s\S]*?)</title>", 1))


def page_kind(url: Column) -> Column:
    """TX7."""
    path = F.when(F.startswith(url, F.lit("/")), url).otherwise(path_of(url))
    return (
        F.when(F.startswith(path, F.lit("/article/")), F.lit("article"))
        .when(F.regexp_like(path, F.lit(r"^/topic(?:/|$)")), F.lit("topic"))
        .when(F.regexp_like(path, F.lit(r"^/(?:issues|weekly|archive|sources)(?:/|$)")) | (path == "/"), F.lit("collection"))
        .otherwise(F.lit("page"))
    )


def links(html: Column) -> Column:
    """TX8. Targets of all anchors."""
    return F.regexp_extract_all(html, F.lit(r"(?i)<a\b[^>]+href=[\"']([^\"']+)[\"']"), F.lit(1))


def visible(html: Column) -> Column:
    return F.regexp_replace(html, r"(?i)<script[\s\S]*?</script>|<style[\s\S]*?</style>", " ")


def tag_count(html: Column, tag: str) -> Column:
    """TX9. Tags outside scripts and styles."""
    return F.regexp_count(visible(html), F.lit(rf"(?i)<{tag}\b"))


def jsonld_blocks(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(_LD_BLOCK), F.lit(1)), strip)


def jsonld_errors(html: Column) -> Column:
    return F.size(F.filter(jsonld_blocks(html), lambda b: F.try_parse_json(b).isNull()))


def jsonld_objects(html: Column) -> Column:
    """TX6. Every top-level object, array member and ``@graph`` member as a variant."""

    def members(v: Column) -> Column:
        as_list = F.try_variant_get(v, "$", "array<variant>")
        return F.when(as_list.isNotNull(), as_list).otherwise(F.array(v))

    parsed = F.filter(F.transform(jsonld_blocks(html), F.try_parse_json), lambda v: v.isNotNull())
    top = F.flatten(F.transform(parsed, members))
    graph = F.flatten(F.transform(top, lambda v: F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array().cast("array<variant>"))))
    return F.concat(top, graph)


def variant_types(v: Column) -> Column:
    one = F.try_variant_get(v, "$['@type']", "string")
    many = F.try_variant_get(v, "$['@type']", "array<string>")
    return F.coalesce(many, F.array_compact(F.array(one)))


def jsonld_types(html: Column) -> Column:
    return F.flatten(F.transform(jsonld_objects(html), variant_types))


#: Levels of nested objects and lists that are searched in JSON-LD.
JSONLD_DEPTH = 6


def jsonld_nodes(html: Column, depth: int = JSONLD_DEPTH) -> Column:
    """Every (key, value) of all JSON-LD objects, nested ones included; members of a list have an empty key."""
    nothing = F.array().cast("array<struct<key:string,value:variant>>")

    def children(v: Column) -> Column:
        fields = F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
        members = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda m: F.struct(F.lit("").alias("key"), m.alias("value")))
        return F.coalesce(members, fields, nothing)

    def below(nodes: Column, left: int) -> Column:
        if left == 0:
            return nodes
        # Each level is bound once, otherwise the expression would double with every level.
        deeper = F.transform(F.array(F.flatten(F.transform(nodes, lambda n: children(n["value"])))), lambda level: below(level, left - 1))
        return F.concat(nodes, F.get(deeper, F.lit(0)))

    parsed = F.filter(F.transform(jsonld_blocks(html), F.try_parse_json), lambda v: v.isNotNull())
    return below(F.transform(parsed, lambda v: F.struct(F.lit("").alias("key"), v.alias("value"))), depth)


def image_urls(v: Column) -> Column:
    """URLs of an image value: a string, an object with a url, or a list of either."""
    def one(x: Column) -> Column:
        plain = F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))
        return F.coalesce(plain, F.try_variant_get(x, "$.url", "string"))

    listed = F.transform(F.try_variant_get(v, "$", "array<variant>"), one)
    return F.array_compact(F.coalesce(listed, F.array(one(v))))


def lead_image(html: Column, url: Column) -> Column:
    """TX4. First usable image: Open Graph, Twitter card, image_src link, JSON-LD."""
    metas, link_tags = tag_attributes(html, "meta"), tag_attributes(html, "link")

    def named(value: str) -> Column:
        hits = F.filter(metas, lambda m: (m["property"] == value) | (m["name"] == value))
        return F.transform(hits, lambda m: m["content"])

    src = F.transform(F.filter(link_tags, lambda m: m["rel"] == "image_src"), lambda m: m["href"])

    ld = F.transform(F.filter(jsonld_nodes(html), lambda n: n["key"].isin("image", "contentUrl", "thumbnailUrl")), lambda n: image_urls(n["value"]))
    ld = F.flatten(ld)
    candidates = F.concat(named("og:image"), named("twitter:image"), named("twitter:image:src"), src, ld)
    cleaned = F.filter(F.transform(candidates, lambda u: clean_image_url(u, url)), lambda u: u.isNotNull())
    return F.try_element_at(cleaned, F.lit(1))


def feed_item_count(xml: Column) -> Column:
    """TX10."""
    return F.regexp_count(text(xml), F.lit(r"(?i)<(?:item|entry)(?:\s|>)"))


def looks_like_feed(xml: Column, content_type: Column) -> Column:
    by_type = F.regexp_like(text(content_type), F.lit("(?i)xml|rss|atom"))
    # The root element, after declarations and comments.
    return by_type | F.regexp_like(text(xml), F.lit(r"(?is)^[\s\uFEFF]*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<![^>]*>\s*)*+<(?:rss|feed|rdf:RDF)\b"))


def newest_feed_date(xml: Column) -> Column:
    from .dates import parse_timestamp

    names = "pubDate|published|updated|dc:date"
    raw = F.regexp_extract_all(text(xml), F.lit(rf"(?i)<(?:{names})[^>]*>([\s\S]*?)</(?:{names})>"), F.lit(1))
    dates = F.transform(raw, lambda v: parse_timestamp(F.trim(F.regexp_replace(v, r"<!\[CDATA\[|\]\]>|<[^>]+>", ""))))
    return F.array_max(dates)
