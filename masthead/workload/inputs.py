"""The article table the registered queries run on, derived from ``documents``.

The documents carry no headlines, scrape times or flags; these follow from the document id, such that every
state, rule and outcome occurs. The SQL text is the same for Spark and for the checking engine, but for the
name of the string type and of the function that takes the first line.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.functions.payload import deflate
from masthead.sources.articles import read_articles
from masthead.sources.staging import shared_folder

AS_OF = 1704672000

# Columns: the article's (its text still plain, as `content`), its language and source, `raw`, a headline as a model
# might write it, and `broken`, why the packed text cannot be read (its content then counts as empty).
ARTICLE_VIEW = """
select doc_id as id, broken, case when doc_id % 19 <> 3 then lang end as lang, case when doc_id % 23 <> 5 then source end as source,
  case doc_id % 12 when 0 then 'Live Updates: ' || t when 1 then t || ' explained' when 2 then 'Opinion | ' || t
    when 3 then t || ' | Comment' when 4 then 'Editorial: ' || t when 5 then 'A | B | ' || t
    when 6 then cast(null as {string}) else t end as title,
  case when broken is not null then '' when doc_id % 17 = 0 then 'Opinion ' || text
    when doc_id % 13 = 4 then 'On Jan. 5, 2024, ' || text when doc_id % 13 = 6 then 'on  september 30 2023 ' || text
    when doc_id % 13 = 8 then '**On May 1, 2024** ' || text when doc_id % 13 = 10 then 'On Monday, 5 2024, ' || text
    else text end as content,
  1704672000 - (doc_id * 7919) % 604800 as scraped_at,
  case doc_id % 5 when 0 then cast(null as {string}) when 1 then ''
    when 2 then case when doc_id % 4 = 0 then 'zz yy xx ww vv uu' else t end
    else case when doc_id % 4 = 1 then 'Zz qq vv ' || md5(t) else t || '.' end end as rephrased_title,
  case doc_id % 3 when 0 then cast(null as int) when 1 then 0 else 1 end as headline_verified,
  case doc_id % 8 when 0 then '"' || t || '"' when 1 then '**' || t || '**' when 2 then t || '.'
    when 3 then '  ' || t || '  ' when 4 then '' when 5 then 'नमस्ते ' || t when 6 then '''*' || t || '*'''
    else t end as raw
from (select doc_id, lang, source, text, trim({first_line}) as t, case when text is null then null
    when doc_id % 37 = 10 then 'not compressed' when doc_id % 41 = 5 then 'cut off' when doc_id % 43 = 15 then 'damaged'
    when doc_id % 47 = 20 then 'not UTF-8' end as broken
  from {documents}) x
"""

_PACKED = zlib.compress(b"A text that nobody will read. " * 20)
_BROKEN = {
    "not compressed": b"A text that was never packed.",
    "cut off": _PACKED[:-7],
    "damaged": _PACKED[:9] + bytes([_PACKED[9] ^ 255]) + _PACKED[10:],
    "not UTF-8": zlib.compress(b"Caf\xe9"),
}


def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view above over the documents of ``sf_dir``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    query = ARTICLE_VIEW.replace("{string}", "string").replace(
        "{first_line}", "substring_index(text, chr(10), 1)"
    )
    return spark.sql(query, documents=documents)


_stored: dict[tuple[str, str], str] = {}


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article table with packed text, written once per session and read from then on."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    if key not in _stored:
        path = f"{shared_folder(spark)}/articles-{len(_stored)}-{key[0]}"
        texts = article_texts(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism, "id")
        payload = deflate(F.col("content"))
        for cause, packed in _BROKEN.items():
            payload = F.when(F.col("broken") == cause, F.lit(packed)).otherwise(payload)
        texts.select(
            "id",
            "title",
            payload.alias("rephrased_article"),
            "scraped_at",
            "rephrased_title",
            "headline_verified",
        ).write.mode("overwrite").parquet(path)
        _stored[key] = path
    return read_articles(spark, _stored[key])


def articles_path(spark: SparkSession, sf_dir: str) -> str:
    articles(spark, sf_dir)
    return _stored[(spark.conf.get("spark.app.id"), sf_dir)]
