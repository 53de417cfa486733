"""Personal data: base patterns, and information-theoretic sanitisation of terms.

The values that the base patterns find are protected entities, and so are the
parts of them that come back in other values (an address's domain and user, a
network, a card's issuer, a telephone area): a value that occurs once has its
evidence there. A term reveals an entity as far as the corpus shows both
together: its disclosure is the pointwise mutual information of term and entity
over documents, divided by the entity's information content. 1 means that the
term occurs with the entity only, 0 that it says nothing. In a document with the
entity, terms at ``REMOVE`` or more are removed and those at ``GENERALISE`` or more
are replaced by a general mark. A term is a whole word of letters and digits,
however short. Entity and term must meet in ``MIN_SUPPORT`` documents, and the
meetings must tell ``EVIDENCE`` bits together (each tells the entity's information
content, so what many documents hold needs more of them): fewer come about by
chance. Counts cover every document.

SQL functions only. What is kept of a document is its entities and its own terms, so
the work grows with its text, not with the other documents of its entities.
Counts are added up per task before each shuffle; term counts over the corpus are
taken for candidate terms alone, which are broadcast up to ``BROADCAST_TERMS`` and
joined beyond.

Defined cases: a null text counts as empty; whole texts are scanned; every row
is a document of its own, whatever its doc_id, and repeated rows count as
often as they occur; a term that reveals several entities of its text counts with
the largest disclosure; an entity in all documents discloses nothing; very long
texts are listed with each of their terms once; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import document_columns, documents, text_or_empty, written
from .spans import found, listed, placed, replaced

# Matches start at the start of a run or where the last match ended (\G): the places where
# the plain patterns can match, without trying every character of a long run.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@"
         r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
#: Sixteen digits or more; a run of fewer fails as a whole.
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
BYTE = r"^0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"

#: A whole word: letters (with their marks) and digits of any script, from one character.
TERM = r"[\p{L}\p{M}\p{N}]++"
MIN_SUPPORT = 3
EVIDENCE = 10.0
GENERALISE = 0.6
REMOVE = 0.9
BROADCAST_TERMS = 200_000


def _ip(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: p.rlike(BYTE))


def _card(m: Column) -> Column:
    digits = F.regexp_replace(m, r"[^0-9]", "")
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)
    return F.when((n >= 16) & (n <= 19), luhn % 10 == 0).otherwise(F.lit(False))


def _phone(m: Column) -> Column:
    return F.length(F.regexp_replace(m, r"[^0-9]", "")).between(8, 15)


def _named(col: str | Column, kind: str | Column, number: int) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.transform(col, lambda s: F.struct(
        F.lit(number).alias("number"), s["start"].alias("start"), s["end"].alias("end"),
        kind.alias("kind"), s["match"].alias("match")))


def base_spans(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, text, base): base spans by kind, then start."""
    text = F.col("text")
    d = document_columns(docs, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    none = F.expr("cast(array() as array<string>)")
    d = d.withColumns({
        "email": F.when(F.contains(text, F.lit("@")), found(text, EMAIL)).otherwise(none),
        "ip": F.when(F.regexp_like(text, F.lit(r"[0-9]\.[0-9]")), found(text, IP)).otherwise(none),
        "card": F.when(F.regexp_like(text, F.lit(r"[0-9][\x20-]?[0-9]")), found(text, CARD)).otherwise(none),
        "phone": F.when(F.contains(text, F.lit("+")), found(text, PHONE)).otherwise(none)})
    d = d.select("doc_id", "text", placed(text, EMAIL, "email", lambda m: F.lit(True)).alias("email"),
                 placed(text, IP, "ip", _ip).alias("ip"), placed(text, CARD, "card", _card).alias("card"),
                 placed(text, PHONE, "phone", _phone).alias("phone"))
    return d.select("doc_id", "text", F.concat(*[_named(k, k, i) for i, k in enumerate(KINDS)]).alias("base"))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1)))


def _entities(span: Column) -> Column:
    """A base span's value, and the parts of it that other values may share."""
    kind, value = span["kind"], F.lower(span["match"])
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = lambda name, v: F.concat(F.lit(f"{name}:"), v)
    parts = (F.when(kind == "email", F.array(part("domain", F.substring_index(value, "@", -1)),
                                             part("user", F.substring_index(value, "@", 1))))
             .when(kind == "ip", F.array(part("network", F.substring_index(value, ".", 2))))
             .when(kind == "card", F.array(part("issuer", F.substring(digits, 1, 6))))
             .otherwise(F.array(part("area", F.substring(digits, 1, 4)))))
    return F.concat(F.array(F.concat_ws(":", kind, value)), parts)


def disclosures(docs: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row_id, eid, term) of the rows with an entity of enough documents, their own
    terms only, and (eid, term, disclosure) of all that meet often enough.

    ``base`` holds base spans by row_id, with ``etext``, the text of rows that have a span. Meetings are
    exploded where they are counted or looked up and never written: a task adds up its own first."""
    entities = base.where("size(base) > 0").select("row_id", F.explode(F.array_distinct(F.flatten(F.transform(
        "base", _entities)))).alias("entity"))
    support = written(entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
                      .where(F.col("n_entity") >= MIN_SUPPORT)
                      .withColumn("eid", F.monotonically_increasing_id()), "pii_support")
    held = entities.join(support, "entity").groupBy("row_id").agg(  # at most the text's own entities
        F.collect_list(F.struct("eid", "n_entity")).alias("entities"))
    rows = written(base.where("etext is not null").join(held, "row_id").select(
        "row_id", "entities", _terms(F.col("etext")).alias("terms")), "pii_rows")
    met = rows.select("row_id", F.explode("entities").alias("e"), "terms").select(
        "row_id", "e.eid", "e.n_entity", F.explode("terms").alias("term"))
    n_docs = F.lit(float(max(1, base.count())))
    content = F.log2(n_docs / F.col("n_entity"))
    together = written(met.groupBy("eid", "n_entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
                       .where((F.col("n_both") >= MIN_SUPPORT) & (F.col("n_both") * content >= EVIDENCE)), "pii_together")
    candidates = written(together.select("term").distinct(), "pii_terms")
    # a term is listed once a text, so a task sends one number a term
    in_docs = document_columns(docs, "text").select(F.explode(_terms(F.col("text"))).alias("term")).join(
        _small(candidates), "term", "left_semi")
    corpus = in_docs.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    ratio = F.log2(F.col("n_both") * n_docs / (F.col("n_entity") * F.col("n_term"))) / content
    told = together.join(corpus, "term").where(F.col("n_entity") < n_docs)
    return met.select("row_id", "eid", "term"), told.select("eid", "term", ratio.alias("disclosure"))


def _small(table: DataFrame) -> DataFrame:
    """A table for a join, broadcast if it has up to BROADCAST_TERMS rows; a shuffled join beyond."""
    return F.broadcast(table) if table.count() <= BROADCAST_TERMS else table


def flagged_terms(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(row_id, term, mark): the terms of the row's own text that reveal an entity of it."""
    met, told = disclosures(docs, base)
    revealing = written(told.where(F.col("disclosure") >= GENERALISE), "pii_revealing")
    return (met.join(_small(revealing), ["eid", "term"]).groupBy("row_id", "term").agg(F.max("disclosure").alias("d"))
            .select("row_id", "term", F.when(F.col("d") >= REMOVE, "remove").otherwise("generalise").alias("mark")))


def term_spans(base: DataFrame, flagged: DataFrame) -> DataFrame:
    """(row_id, terms): the flagged words of each text as spans in order.

    A text's words are rows here, so its places are a running sum and the flagged ones a join."""
    text = F.col("etext")
    words = F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(1))
    rows = base.where("etext is not null").join(flagged.select("row_id").distinct(), "row_id", "left_semi")
    steps = (rows.withColumns({"words": words, "gaps": F.split(text, TERM, -1)})
             .select("row_id", F.posexplode(F.arrays_zip(F.slice("gaps", 1, F.size("words")).alias("gap"),
                                                         F.col("words").alias("word")))).select("row_id", "pos", "col.*"))
    along = Window.partitionBy("row_id").orderBy("pos")
    placed_words = steps.withColumn("end", F.sum(F.length("gap") + F.length("word")).over(along).cast("int"))
    hits = placed_words.withColumn("term", F.lower("word")).join(flagged, ["row_id", "term"])
    span = F.struct((F.col("end") - F.length("word")).alias("start"), "end", "mark", "word")
    return hits.groupBy("row_id").agg(F.array_sort(F.collect_list(span)).alias("t")).select(
        "row_id", F.transform("t", lambda s: F.struct(
            F.lit(len(KINDS)).alias("number"), s["start"].alias("start"), s["end"].alias("end"),
            s["mark"].alias("kind"), s["word"].alias("match"))).alias("terms"))


def personal_spans(docs: DataFrame) -> DataFrame:
    """documents -> (doc_id, etext, base, spans), a row per row: ``base`` by kind and start,
    ``spans`` with the flagged words after them; ``etext`` is the text of rows with a span."""
    base = written(base_spans(docs).select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.when(F.size("base") > 0, F.col("text")).alias("etext"), "base"), "pii_base")
    flagged = written(flagged_terms(docs, base), "pii_flagged")
    joined = base.join(term_spans(base, flagged), "row_id", "left")
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(
        F.concat("base", F.filter("terms", lambda t: ~F.exists(
            "base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))))
    return joined.select("doc_id", "etext", "base", spans.alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """(doc_id, etext sanitised) of the rows with personal data: entities become their kind in
    brackets, revealing terms go or become [TERM]."""
    mark = lambda s: F.when(s["kind"] == "remove", "").when(
        s["kind"] == "generalise", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    in_order = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return (personal_spans(docs).where("etext is not null").withColumn("ordered", in_order)
            .select("doc_id", replaced(F.col("etext"), F.col("ordered"), mark).alias("text")))


def op6_disclosure(spark, sf_dir: str) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return personal_spans(documents(spark, sf_dir)).select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
