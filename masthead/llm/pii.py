"""Personal data: patterns, and terms that give a protected entity away.

The patterns find entities: e-mail and IP addresses, card and phone numbers. A term can reveal an entity as well, if it
hardly occurs without it. How much it reveals is estimated from the corpus: the information content of the entity less the
pointwise mutual information of term and entity are the bits that a reader of the term still lacks. That is minus the logarithm of the
share of documents with the term that name the entity. To the documents with the term one is added that does not name it, so little
evidence counts for less. The disclosure of a term is this share. In a document that names the entity, terms that leave
at most one bit open (a disclosure from ``GENERALISE`` on) are replaced by what kind of word they are, those that leave
almost nothing open (from ``REMOVE`` on) are deleted.

Built-in functions only. Positions come from the lengths of the pieces that a pattern leaves. Quantified groups in the patterns
are possessive, and attempts inside a run that has just failed are ruled out, so long junk costs neither stack nor square time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masthead.llm.common import staging

REMOVE = 0.87
GENERALISE = 0.5

_LOCAL = "A-Za-z0-9._%+-"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Kind -> a character that must be there, pattern. In the order in which kinds are listed.
KINDS = {
    "email": ("@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"),
    "ip": (".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("", r"[0-9](?:[ -]?[0-9])++"),
    "phone": ("+", r"\+[0-9][ ().0-9-]+[0-9]"),
}
TERM_KIND = "term"
_WORD = r"[\p{L}\p{N}]+"
_GAP = r"[^\p{L}\p{N}]+"


def _has(kind: str) -> Column:
    """A cheap test that every text with a match passes."""
    mark, pattern = KINDS[kind]
    text = F.col("text")
    if kind == "card":
        return text.rlike("[0-9](?:[ -]?[0-9]){13}")
    if kind == "ip":
        return text.rlike(r"[0-9]\.[0-9]") & text.rlike(pattern)
    return text.contains(mark) & text.rlike(pattern)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid() -> Column:
    value, digits = F.col("value"), _digits(F.col("value"))
    luhn = F.expr(
        """aggregate(sequence(1, 19), 0, (sum, i) -> sum + int(substring(padded, i, 1)) * (2 - i % 2)
           - case when i % 2 = 0 and int(substring(padded, i, 1)) > 4 then 9 else 0 end) % 10 = 0"""
    )
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(F.col("kind") == "card", F.when(F.length(digits).between(14, 19), luhn).otherwise(False))
        .otherwise(F.length(digits).between(10, 15))
    )


def _placed(rows: DataFrame, keys: list[str], pieces: Column, matches: Column) -> DataFrame:
    """One row per match, with start, end (code points) and value. ``pieces`` are the texts around the matches."""
    nth = Window.partitionBy(*keys).orderBy("nth")
    return (
        rows.select(
            *keys, F.posexplode(F.arrays_zip(F.transform(pieces, F.length).alias("gap"), matches.alias("value"))).alias("nth", "m")
        )
        .filter("m.value is not null")
        .withColumn("end", F.sum(F.col("m.gap") + F.length("m.value")).over(nth).cast("long"))
        .select(*keys, (F.col("end") - F.length("m.value")).alias("start"), "end", F.col("m.value").alias("value"))
    )


def base_spans(hits: DataFrame) -> DataFrame:
    """(row, kind, rank of the kind, start, end, entity) of the valid matches of the patterns in ``hits`` (row, text)."""
    found = None
    for rank, (kind, (_, pattern)) in enumerate(KINDS.items()):
        own = hits.filter(_has(kind)).select("row", F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), "text")
        placed = _placed(
            own, ["row", "kind", "rank"], F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        )
        found = placed if found is None else found.unionByName(placed)
    entity = F.when(F.col("kind").isin("card", "phone"), _digits(F.col("value"))).otherwise(F.lower("value"))
    return (
        found.withColumn("padded", F.lpad(_digits(F.col("value")), 19, "0"))
        .filter(_valid())
        .select("row", "kind", "rank", "start", "end", F.concat("kind", F.lit(":"), entity).alias("entity"))
    )


def _terms(text: Column) -> Column:
    """The distinct terms of a text, lower case."""
    split = F.split(F.lower(text), _GAP, -1)
    return F.array_distinct(F.filter(split, lambda t: t != ""))


def revealing_terms(docs: DataFrame, hits: DataFrame, spans: DataFrame, stage) -> DataFrame:
    """(row, term, disclosure) of the terms of a row that reveal an entity named in it, with the most that one of them reveals.

    Parts of the entities count as terms too: where they stand alone they give their entity away.
    """
    named = spans.select("row", "entity").distinct()
    entities = named.groupBy("entity").agg(F.count("*").alias("n_entity"))
    named = stage.save(named.join(entities, "entity"), "named")
    words = hits.join(named.select("row").distinct(), "row", "left_semi")
    words = words.select("row", F.explode(_terms(F.col("text"))).alias("term"))
    everywhere = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    # A term with more documents than this cannot have half of them in common with the entity.
    rare = F.col("n_term") <= 2 * F.col("n_entity") - 1
    pairs = stage.save(named.join(words, "row").join(everywhere, "term").filter(rare).select("row", "entity", "term", "n_term"), "pairs")
    together = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("n_term").alias("n_term"))
    disclosure = (F.col("n_both") / (F.col("n_term") + 1)).alias("disclosure")
    flagged = together.select("entity", "term", disclosure).filter(F.col("disclosure") >= GENERALISE)
    return pairs.join(flagged, ["entity", "term"]).groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (kind, start, end, disclosure; in order), text, and the columns of ``keep``.

    Positions are code points, the end exclusive. Null text counts as empty; without personal data the list is empty. Rows
    that repeat an id get a row each, and ids may be null. An empty table gives no rows.
    """
    stage = staging(docs.sparkSession)
    docs = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(c) for c in keep or [id_col]]).alias("kept"),
    )
    any_kind = F.lit(False)
    for kind in KINDS:
        any_kind = any_kind | _has(kind)
    hits = stage.save(docs.filter(any_kind).withColumn("row", F.monotonically_increasing_id()), "hits")
    spans = stage.save(base_spans(hits.select("row", "text")), "base")
    strongest = stage.save(revealing_terms(docs.select("text"), hits, spans, stage), "revealing")
    own = F.struct("start", "rank", "end", "kind", F.lit(1.0).alias("disclosure"))
    base = stage.save(spans.groupBy("row").agg(F.sort_array(F.collect_list(own)).alias("base")), "base-lists")
    marked = hits.select("row", "text").join(strongest.select("row").distinct(), "row", "left_semi")
    words = _placed(
        marked, ["row"], F.split("text", _WORD, -1), F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))
    ).withColumn("term", F.lower("value"))
    placed = (
        words.join(strongest, ["row", "term"])
        .join(base, "row")
        .filter("not exists(base, b -> b.start < end and start < b.end)")
        .withColumn("kind", F.lit(TERM_KIND))
        .withColumn("rank", F.lit(len(KINDS)))
    )
    by_term = F.struct("start", "rank", "end", "kind", "disclosure")
    terms = placed.groupBy("row").agg(F.sort_array(F.collect_list(by_term)).alias("found"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,disclosure:double>>")
    result = hits.join(base, "row", "left").join(terms, "row", "left").select(
        "doc_id", "text", "kept", F.sort_array(F.concat(F.coalesce("base", none), F.coalesce("found", none))).alias("spans")
    )
    return docs.filter(~any_kind).select("doc_id", "text", "kept", none.alias("spans")).unionByName(result)


def sanitised() -> Column:
    """The text of a row of ``find`` without its spans: base ones leave their kind, terms what kind of word they are, or nothing."""
    islands = """aggregate(spans, cast(array() as array<struct<start:bigint,end:bigint,by:string>>), (done, s) ->
        case when size(done) > 0 and s.start < element_at(done, -1).end
          then concat(slice(done, 1, size(done) - 1), array(struct(element_at(done, -1).start as start,
            greatest(element_at(done, -1).end, s.end) as end, element_at(done, -1).by as by)))
          else concat(done, array(struct(s.start as start, s.end as end,
            case when s.kind <> '{term}' then concat('[', upper(s.kind), ']') when s.disclosure >= {remove} then ''
              when substring(text, int(s.start) + 1, int(s.end - s.start)) rlike '^[0-9]+$' then '[NUMBER]' else '[WORD]' end as by))) end)"""
    islands = islands.format(term=TERM_KIND, remove=REMOVE)
    return F.expr(
        f"""case when size(spans) = 0 then text else aggregate({islands}, struct('' as out, 0L as at),
          (a, s) -> struct(concat(a.out, substring(text, int(a.at) + 1, int(s.start - a.at)), s.by) as out, s.end as at),
          a -> concat(a.out, substring(text, int(a.at) + 1, length(text)))) end"""
    )


def _joined(kinds: str) -> Column:
    return F.expr(f"concat_ws(',', transform(filter(spans, s -> {kinds}), s -> concat(s.kind, ':', s.start, ':', s.end)))")


def digest(found: DataFrame) -> DataFrame:
    """Counts and span lists of the rows of ``find``, without text."""
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    terms = F.expr(f"cast(size(filter(spans, s -> s.kind = '{TERM_KIND}')) as long)").alias("n_term")
    return found.select(
        "doc_id", *counts, F.sha2(_joined(f"s.kind <> '{TERM_KIND}'"), 256).alias("base_sha256"), _joined("true").alias("spans"), terms
    )
