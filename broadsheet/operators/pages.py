"""CL27, CL28: checks of HTML pages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PRIMARY_TYPES
from ..functions import html as H
from ..functions.patterns import codes, text


def with_meta(pages: DataFrame) -> DataFrame:
    """TX5 for a table with ``html``: head values, read from the tags in any attribute order."""
    tagged = pages.withColumns({"_metas": H.tag_attributes(F.col("html"), "meta"), "_links": H.tag_attributes(F.col("html"), "link")})
    m = F.col("_metas")
    return tagged.withColumns(
        {
            "title": H.page_title(F.col("html")), "description": H.meta_content(m, "name", "description"),
            "canonical": H.canonical_url(F.col("_links")), "robots": F.lower(H.meta_content(m, "name", "robots")),
            "og_url": H.meta_content(m, "property", "og:url"), "og_title": H.meta_content(m, "property", "og:title"),
            "og_description": H.meta_content(m, "property", "og:description"), "og_image": H.meta_content(m, "property", "og:image"),
        }
    ).drop("_metas", "_links")


def _value(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def page_contract(pages: DataFrame) -> DataFrame:
    """CL27. Critical codes of each listed page (``url``, ``html``) by its kind."""
    p = with_meta(pages).withColumns({"kind": H.page_kind(F.col("url")), "h1": H.tag_count(F.col("html"), "h1"), "_ld": H.jsonld_objects(F.col("html")), "_errors": H.jsonld_errors(F.col("html"))})
    allowed = F.lit(None).cast("array<string>")
    for kind, types in PRIMARY_TYPES.items():
        allowed = F.when(F.col("kind") == kind, F.array(*[F.lit(t) for t in types])).otherwise(allowed)
    p = p.withColumn("_allowed", allowed).withColumn("_primary", F.filter("_ld", lambda v: F.arrays_overlap(H.variant_types(v), F.col("_allowed"))))
    article, primary = F.col("kind") == "article", F.col("_primary")
    n_title, n_desc = F.length("title"), F.length("description")
    found = codes(
        (F.col("canonical") == "", "canonical-missing"),
        ((F.col("canonical") != "") & (F.col("canonical") != F.col("url")), "canonical-mismatch"),
        (F.contains("robots", F.lit("noindex")), "sitemap-page-noindex"),
        (~n_title.between(10, 180), "title-invalid"),
        (~n_desc.between(30, 300), "description-invalid"),
        (F.col("og_url") != F.col("url"), "og-url-mismatch"),
        (F.col("og_title") == "", "og-title-missing"),
        (F.col("og_description") == "", "og-description-missing"),
        (article & (F.col("og_image") == ""), "article-og-image-missing"),
        (F.col("h1") < 1, "h1-missing"),
        (F.col("_errors") > 0, "jsonld-parse-error"),
        (F.size(primary) == 0, "primary-jsonld-missing"),
        (F.exists(primary, lambda v: (text(_value(v, "url")) != "") & (_value(v, "url") != F.col("url"))), "jsonld-url-mismatch"),
        (article & F.exists(primary, lambda v: text(_value(v, "headline")) == ""), "article-headline-missing"),
        (article & F.exists(primary, lambda v: text(_value(v, "image")) == ""), "article-jsonld-image-missing"),
    )
    return p.withColumn("codes", found).drop("_ld", "_errors", "_allowed", "_primary")


def article_checks(pages: DataFrame) -> DataFrame:
    """CL28. Findings on article pages (``url``, ``html``)."""
    p = with_meta(pages).withColumn("_types", H.jsonld_types(F.col("html")))
    found = codes(
        (H.jsonld_errors(F.col("html")) > 0, "article-jsonld-invalid"),
        (F.col("canonical") == "", "article-canonical-missing"),
        ((F.col("canonical") != "") & (F.col("canonical") != F.col("url")), "article-canonical-mismatch"),
        (F.contains("robots", F.lit("noindex")), "article-noindex"),
        (~F.regexp_like("html", F.lit(r"(?i)<h1\b")), "article-h1-missing"),
        (~F.arrays_overlap("_types", F.array(*[F.lit(t) for t in PRIMARY_TYPES["article"]])), "article-jsonld-article-type-missing"),
    )
    return p.withColumn("codes", found).drop("_types")


def homepage_checks(pages: DataFrame, data_id: str, minimum: int = 40) -> DataFrame:
    """CL28. Findings on homepages, which carry the edition as inline JSON in the script element ``data_id``."""
    raw = F.regexp_extract("html", rf"(?i)<script\b[^>]*\bid=[\"']{re.escape(data_id)}[\"'][^>]*>([\s\S]*?)</script>", 1)
    p = pages.withColumns({"_raw": F.trim(raw), "_issue": F.try_parse_json(F.trim(raw))})
    sizes = [F.coalesce(F.size(F.try_variant_get("_issue", f"$.{n}", "array<variant>")), F.lit(0)) for n in ("articles", "briefs", "stories", "recent")]
    sizes = [F.greatest(s, F.lit(0)) for s in sizes]
    declared = F.try_variant_get("_issue", "$.count", "int")
    read = F.col("_issue").isNotNull()
    found = codes(
        (F.col("_raw") == "", "homepage-issue-missing"),
        ((F.col("_raw") != "") & ~read, "homepage-issue-invalid"),
        (~F.regexp_like("html", F.lit(r"(?i)<h1\b")), "homepage-h1-missing"),
        (~F.regexp_like("html", F.lit(r"(?i)<main\b[^>]*id=[\"']main-content[\"']")), "homepage-main-missing"),
        (~F.regexp_like("html", F.lit("(?i)SearchAction")), "homepage-search-action-missing"),
        (~F.regexp_like("html", F.lit(r"(?i)href=[\"']/archive/")), "homepage-archive-link-missing"),
        (read & (F.coalesce(declared, F.lit(-1)) < minimum), "homepage-edition-below-minimum"),
        (read & (sum(sizes, F.lit(0)) < minimum), "homepage-static-items-below-minimum"),
        (~F.regexp_like("html", F.lit(r"(?i)href=[\"']/(?:article|issues/)[^\"']+")), "homepage-article-links-missing"),
    )
    return p.withColumn("codes", found).drop("_raw", "_issue")


def sitemap_checks(xml: Column, expected: Column) -> Column:
    """CL28. News sitemap: namespace and number of URLs."""
    n = F.size(F.regexp_extract_all(xml, F.lit("<loc>([^<]+)</loc>"), F.lit(1)))
    return codes(
        (~F.contains(xml, F.lit('xmlns:news="http://www.google.com/schemas/sitemap-news/0.9"')), "news-sitemap-namespace-missing"),
        (expected.isNotNull() & (n != expected), "news-sitemap-count-mismatch"),
    )
