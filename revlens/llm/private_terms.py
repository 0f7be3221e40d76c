"""Personal data: pattern spans, and terms whose corpus co-occurrence with a protected
value discloses it. DataFrame functions only.

Base spans are the leftmost non-overlapping matches of four patterns. The information-
theoretic part treats each matched value as a protected entity: the terms (words) of all
distinct texts that hold it are counted, each lower-cased by itself, and a term t discloses
an entity e when they meet in at least ``MIN_SUPPORT`` distinct texts and the information that t gives
about e, log2(P(e|t) / P(e)), is at least ``DISCLOSURE`` of all the information there is in
e, -log2 P(e). Such terms become spans of kind ``term`` in every text that holds them,
and ``sanitise`` removes them, while values are generalised to their kind.

Defined results: a null text is empty; an empty text has no spans; a null ``doc_id`` is
kept; repeated rows each get their result, but count as one text in the statistics; an
empty table gives no rows. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, staged

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the fixed patterns: the classes that follow one another are
# disjoint, so they match the same and need neither backtracking nor recursion. A run
# that fails from its start fails from all its characters, so matching starts only at
# a run's start or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# A term: letters, marks and digits, also with hyphens, apostrophes and underscores between them.
_WORD = r"[\p{L}\p{M}\p{N}]"
_BEFORE = rf"(?<!{_WORD})(?<!{_WORD}['’_-])"
_AFTER = rf"(?!{_WORD}|['’_-]{_WORD})"
TERM = rf"{_BEFORE}(?={_WORD}{{2}}|{_WORD}['’_-]{_WORD}){_WORD}++(?:['’_-]{_WORD}++)*+"
MIN_SUPPORT = 3
DISCLOSURE = 0.9
BLOCK_CHARS = 1024
BROADCAST_BYTES = 32 * 2 ** 20  # of terms, or of texts' lists of disclosing terms


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda s, i: s + F.when((n - i) % 2 == 1,
                                F.expr("0") + F.substring(digits, i, F.lit(1)).cast("int") * 2
                                - F.when(F.substring(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0))
        .otherwise(F.substring(digits, i, F.lit(1)).cast("int")))
    return total % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


_NONE = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(values: Column, join, empty: int) -> Column:
    """Running ``join`` of an array of numbers, each pass over it doubling the reach."""
    def passes(v: Column) -> Column:
        n = F.size(v)
        steps = F.when(n > 1, F.sequence(F.lit(0), F.ceil(F.log2(n.cast("double"))).cast("int") - 1))
        shifted = lambda acc, k: F.slice(F.concat(
            F.array_repeat(F.lit(empty).cast("bigint"), F.pow(F.lit(2), k).cast("int")), acc), 1, n)
        return F.aggregate(F.coalesce(steps, F.array().cast("array<int>")), v,
                           lambda acc, k: F.zip_with(acc, shifted(acc, k), join))
    return _let(values, passes)


def _spans(text: Column, pattern: Column, kind: str, passes) -> Column:
    """Structs (kind, start, end, value) of a pattern's matches that pass.

    The pieces between matches and the matches alternate, so ends are running sums.
    """
    cut = F.struct(F.split(text, pattern).alias("p"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"))

    def placed(c: Column) -> Column:
        sizes = F.zip_with(c["m"], F.slice(c["p"], 1, F.size(c["m"])), lambda m, p: (F.length(m) + F.length(p)).cast("bigint"))
        return F.zip_with(c["m"], _running(sizes, lambda a, b: a + b, 0), lambda m, end: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(m)).cast("bigint").alias("start"), end.alias("end"), m.alias("value")))
    return F.filter(_let(cut, placed), lambda s: passes(s["value"]))


def _base(text: Column, kind: str) -> Column:
    pattern = F.lit(PATTERNS[kind])
    may = F.contains(text, F.lit(_NEEDS[kind])) if _NEEDS[kind] else F.lit(True)
    if kind in ("ip", "card"):
        may = may & text.rlike("[0-9]{2}|[0-9][ .-][0-9]")
    return (F.when(may & text.rlike(PATTERNS[kind]),
                   _spans(text, pattern, kind, lambda v: _passes(kind, v)))
            .otherwise(F.array().cast(_NONE)))


def with_base(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text, base, doc): the base spans by kind, then start; ``doc`` is the whole row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct("*").alias("doc"))
    for kind in KINDS:
        rows = rows.withColumn(f"_{kind}", _base(F.col("text"), kind))
    return rows.select("row", "doc_id", "text", "doc", F.concat(*[f"_{k}" for k in KINDS]).alias("base"))


def disclosing_terms(rows: DataFrame, min_support: int = MIN_SUPPORT,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """(term): words that disclose some protected value; ``rows`` as with_base gives."""
    key = F.xxhash64("text").alias("key")
    held = (rows.where(F.size("base") > 0).select(key, F.explode("base").alias("s"))
            .select("key", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity")).distinct())
    # a value or term in too few texts can't reach the support: left out before terms are counted
    n_entity = held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= min_support)
    total = rows.agg(F.count_distinct(F.xxhash64("text"))).scalar()
    # they meet in at most n_entity texts, so a term in more than ``most`` texts can't disclose the value
    most = F.pow(F.col("n"), F.lit(1 - disclosure)) * F.pow("n_entity", F.lit(disclosure)) * (1 + 1e-9)
    held = staged(held.join(n_entity, "entity").withColumn("n", total).withColumn("most", most))
    holders = held.groupBy("key").agg(F.max("most").alias("most"))
    words = staged(rows.where(F.size("base") > 0).select(key, "text", "base").dropDuplicates(["key"])
                   .join(holders, "key").select("key", "most", _terms().alias("term")))
    n_near = (words.groupBy("term").agg(F.count("*").alias("n_near"), F.max("most").alias("most"))
              .where((F.col("n_near") >= min_support) & (F.col("n_near") <= F.col("most"))).select("term", "n_near"))
    pairs = (words.select("key", "term").join(n_near, "term").join(held, "key")
             .where(F.col("n_near") <= F.col("most")))
    met = (pairs.groupBy("entity", "term").agg(F.count("*").alias("n_both"), *[F.first(c).alias(c) for c in ("n_near", "n_entity", "n")])
           .where(F.col("n_both") >= min_support))

    def discloses(n_term: str) -> Column:
        info = F.log2(F.col("n_both") * F.col("n") / (F.col(n_term) * F.col("n_entity")))
        return info >= disclosure * F.log2(F.col("n") / F.col("n_entity"))

    # a term is in at least as many texts as it is in with some value: common words can't
    # pass, whatever the corpus counts, and need none
    met = staged(met.where(discloses("n_near")))
    held = (_occurrences(rows, key, met.select("term").distinct())
            .select("key", "term").distinct().groupBy("term").agg(F.count("*").alias("n_term")))
    return met.join(held, "term").where(discloses("n_term")).select("term").distinct()


def _clear() -> Column:
    """The text with its values blanked out, everything else at its place."""
    return F.when(F.size("base") > 0, masked(F.col("text"), F.col("base"), blank=True)).otherwise(F.col("text"))


def _spelt() -> Column:
    """The distinct words of a text outside its values, as they are spelt."""
    return F.array_distinct(F.regexp_extract_all(_clear(), F.lit(TERM), F.lit(0)))


def _terms() -> Column:
    """The distinct terms of a text, one a row: its words, each lower-cased by itself."""
    return F.explode(F.array_distinct(F.transform(_spelt(), F.lower)))


def _occurrences(rows: DataFrame, key: Column, terms: DataFrame) -> DataFrame:
    """(key, spelt, term) of each text that holds one of the terms. Up to BROADCAST_BYTES of terms are
    sent to the texts; more are joined by shuffling the texts' words."""
    terms = staged(terms)
    few = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 64), F.lit(0))).first()[0] <= BROADCAST_BYTES
    words = rows.select(key, F.explode(_spelt()).alias("spelt")).withColumn("term", F.lower("spelt"))
    return words.join(F.broadcast(terms) if few else terms, "term", "left_semi")


def with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds ``terms``: the spans of disclosing terms; base spans stay as they are.

    A text is searched for the spellings that its own words have, so case folding takes place once.
    """
    holders = staged(_occurrences(rows, F.col("row"), terms).groupBy("row")
                     .agg(F.array_sort(F.collect_list("spelt")).alias("_t")))
    size = holders.agg(F.coalesce(F.sum(F.octet_length(F.array_join("_t", "|")) + 64), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        holders = F.broadcast(holders)
    pattern = F.concat(F.lit(f"{_BEFORE}(?:"), F.array_join("_t", "|"), F.lit(f"){_AFTER}"))
    return (rows.join(holders, "row", "left")
            .select("row", "doc_id", "text", "doc", "base",
                    F.when(F.col("_t").isNotNull(), _spans(_clear(), pattern, "term", lambda v: F.lit(True)))
                    .otherwise(F.array().cast(_NONE)).alias("terms")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, min_support: int = MIN_SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """(row, doc_id, text, doc, base, terms) of every text."""
    rows = with_base(docs)
    return with_terms(rows, disclosing_terms(rows, min_support, disclosure))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text held as blocks of BLOCK_CHARS."""
    first = F.floor(start / BLOCK_CHARS).cast("int")
    several = F.slice(blocks, first + 1, F.floor((end - 1) / BLOCK_CHARS).cast("int") - first + 1)
    return F.when(end <= start, F.lit("")).otherwise(
        F.substring(F.array_join(several, ""), (start - first * F.lit(BLOCK_CHARS) + 1).cast("int"), (end - start).cast("int")))


def masked(text: Column, spans: Column, blank: bool = False) -> Column:
    """The text with values generalised to ``[KIND]`` and terms removed, or with all of them blanked by
    as many spaces; of overlapping spans the first one stands, its mask covering the others up to its end.

    Pieces are taken from blocks of the text, so its length and the number of spans add, not multiply.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))

    def one(s: Column, at: Column, blocks: Column) -> Column:
        start = F.greatest(s["start"], at)
        mask = (F.repeat(F.lit(" "), (s["end"] - start).cast("int")) if blank else
                F.when((s["kind"] == "term") | (s["start"] < at), F.lit(""))
                .otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.when(s["end"] <= at, F.lit("")).otherwise(F.concat(_piece(blocks, at, start), mask))

    def pieces(c: Column) -> Column:
        done = F.slice(F.concat(F.array(F.lit(0).cast("bigint")), c["ends"]), 1, F.size(c["ordered"]))
        return F.concat(F.array_join(F.zip_with(c["ordered"], done, lambda s, at: one(s, at, c["blocks"])), ""),
                        _piece(c["blocks"], F.array_max(c["ends"]), F.length(text).cast("bigint")))

    ends = lambda o: _running(F.transform(o, lambda s: s["end"]), lambda a, b: F.greatest(a, b), 0)
    done = _let(_let(ordered, lambda o: F.struct(o.alias("ordered"), ends(o).alias("ends"), blocks.alias("blocks"))), pieces)
    return F.when(F.size(spans) == 0, text).otherwise(done)


def sanitise(docs: DataFrame, min_support: int = MIN_SUPPORT, disclosure: float = DISCLOSURE) -> DataFrame:
    """The documents with values generalised and disclosing terms removed; a null text stays null."""
    found = find(docs, min_support, disclosure)
    text = F.when(F.col("doc.text").isNotNull(), masked(F.col("text"), F.concat("base", "terms")))
    return found.select(*[text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns])
