"""SC4: paper records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import MONTHS, PAPER_MIN_CHARS
from ..functions.patterns import text

_TEXT = T.StructType([T.StructField("_VALUE", T.StringType())])
_PART = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_Label", T.StringType())])
_ID = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_IdType", T.StringType())])
_DATE = T.StructType([T.StructField(n, T.StringType()) for n in ("Year", "Month", "Day", "MedlineDate")])


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


ARTICLE = _struct(
    MedlineCitation=_struct(
        PMID=_TEXT,
        Article=_struct(
            ArticleTitle=_TEXT, Abstract=_struct(AbstractText=T.ArrayType(_PART)),
            Journal=_struct(Title=T.StringType(), JournalIssue=_struct(PubDate=_DATE)),
        ),
    ),
    PubmedData=_struct(ArticleIdList=_struct(ArticleId=T.ArrayType(_ID))),
)


def paper_date(d: Column) -> Column:
    """Partial date: year required, month by name, day within 1 to 28."""
    year = F.coalesce(d["Year"], F.regexp_extract(text(d["MedlineDate"]), r"(?<![A-Za-z0-9_])((?:19|20)\d{2})(?![A-Za-z0-9_])", 1)).try_cast("int")
    name = F.lower(F.substring(F.coalesce(F.nullif(d["Month"], F.lit("")), F.regexp_extract(text(d["MedlineDate"]), "[A-Za-z]{3,}", 0)), 1, 3))
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    month = F.when(at > 0, at).otherwise(1).cast("int")
    day = F.least(F.lit(28), F.greatest(F.lit(1), F.coalesce(d["Day"].try_cast("int"), F.lit(1))))
    return F.when(year.between(1900, 2100), F.make_date(year, month, day))


def flatten_papers(records: DataFrame, max_chars: int | None = None) -> DataFrame:
    """SC4. Records of the article shape as candidate rows with enough abstract; ``max_chars`` shortens it."""
    art = F.col("MedlineCitation.Article")
    parts = F.transform(
        art["Abstract"]["AbstractText"],
        lambda p: F.concat(F.when(text(p["_Label"]) != "", F.concat(p["_Label"], F.lit(": "))).otherwise(F.lit("")), text(p["_VALUE"])),
    )
    abstract = F.array_join(F.filter(parts, lambda p: p != ""), "\n")
    abstract = abstract if max_chars is None else F.substring(abstract, 1, max_chars)
    dois = F.filter(F.col("PubmedData.ArticleIdList.ArticleId"), lambda i: i["_IdType"] == "doi")
    pmid, title = text(F.col("MedlineCitation.PMID._VALUE")), text(art["ArticleTitle"]["_VALUE"])
    url = F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/"))
    rows = records.select(
        F.substring(F.md5(F.when(pmid != "", pmid).otherwise(title)), 1, 10).alias("id"), F.lit("paper").alias("source_type"), pmid.alias("pmid"), title.alias("title"),
        F.coalesce(art["Journal"]["Title"], F.lit("")).alias("journal"), abstract.alias("abstract"), text(F.try_element_at(dois, F.lit(-1))["_VALUE"]).alias("doi"),
        url.alias("url"), paper_date(art["Journal"]["JournalIssue"]["PubDate"]).alias("published_on"),
    )
    return rows.where((F.col("title") != "") & (F.length("abstract") > PAPER_MIN_CHARS))


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """Paper XML files; the reader splits large files by record."""
    records = spark.read.format("xml").option("rowTag", "PubmedArticle").option("valueTag", "_VALUE").schema(ARTICLE).load(path)
    return flatten_papers(records)


def parse_papers(payloads: DataFrame, xml: str = "xml") -> DataFrame:
    """Paper records held in a column, one record per row."""
    parsed = payloads.select(F.from_xml(xml, ARTICLE, {"valueTag": "_VALUE", "attributePrefix": "_"}).alias("a"))
    return flatten_papers(parsed.select("a.*"))
