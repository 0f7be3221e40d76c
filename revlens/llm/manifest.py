"""A Merkle manifest of a table of documents, with proofs by pointer jumping.

Each row is a leaf: the SHA-256 of its columns. The leaves of a language ascend by ``doc_id``;
runs of ``FAN`` consecutive nodes become the digest of their digests until one is left, the
language's subroot, and the subroots become the root in the same way.

Positions come from one sort by ranges: a partition's rows of a language count from the sum of
the rows before it, so no language is ever sorted in one task, and only digests are moved, never
texts. Inner nodes (an eighth of the rows and less at every level) then hold a pointer to an
ancestor and the segment of siblings up to it. Every round joins the nodes to the nodes they
point at: the ancestor's segment is appended, its pointer taken over, and the distance doubles
until all point beyond the root. Leaves take their run's siblings and their parent's segment.

Defined results: a null column is ``-``, unlike an empty one; rows of a null language are a tree
of their own, the first; a null ``doc_id`` is the least of its language; rows that repeat a
``doc_id`` are leaves each, by digest (which of equal rows comes first changes no digest); a
language of one row has its leaf as subroot, and a single subroot is the root; an empty table
gives no rows; columns other than the five are ignored. A row without ``doc_id`` isn't tampered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

FAN = 8
TOP = "root"           # the tree of subroots; the trees of languages are "" (null) and "=" + language
BROADCAST_BYTES = 4 << 20
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(column: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(column).cast("string"), F.lit(":"), column), F.lit("-"))


def _small(df: DataFrame) -> DataFrame:
    """The staged rows, for a broadcast if they are few and short; else a join shuffles."""
    df = staged(df)
    n, chars = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("tree")), F.lit(0))).first()
    return F.broadcast(df) if n * 100 + chars <= BROADCAST_BYTES else df


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, doc_id, leaf, other): ``other`` is the leaf of the lower-cased text where ``tampered``."""
    c = {k: F.col(k).cast("long" if k in ("doc_id", "n_chars") else "string").cast("string") for k in COLUMNS}
    leaf = lambda text: digest(*[_field(text if k == "text" else c[k]) for k in COLUMNS])
    return docs.select(F.coalesce(F.concat(F.lit("="), c["lang"]), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf(c["text"]).alias("leaf"), F.when(tampered, leaf(F.translate(c["text"], _UPPER, _LOWER))).alias("other"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``idx``, their place in their ``tree`` (from 0) by ``order``, and ``total``, the tree's rows."""
    keys = ["tree", *order, "spread"]
    sorted_rows = (rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*keys)
                   .sortWithinPartitions(*keys).drop("spread"))
    kept = staged(sorted_rows.withColumn("at", F.monotonically_increasing_id())).withColumn("part", F.shiftright("at", 33))
    # one row for each partition and tree; partitions hold few trees, as they are ranges of them
    sizes = kept.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = "sum(n) OVER (PARTITION BY tree ORDER BY part ROWS UNBOUNDED PRECEDING) - n - first AS shift"
    sizes = _small(sizes.selectExpr("part", "tree", before, "sum(n) OVER (PARTITION BY tree) AS total"))
    return kept.join(sizes, ["part", "tree"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _hung(runs: DataFrame, level: int) -> DataFrame:
    """Each node of the runs: its id, the id of the node above it and the one segment that parts them."""
    kid = runs.select("tree", "run", F.posexplode("kids").alias("i", "kid"), "kids")
    return kid.select(node("tree", level, "kid.idx").alias("id"), node("tree", level + 1, "run").alias("up"),
                      F.array(_siblings(F.col("kids"), F.col("i"))).alias("path"))


def node(tree: str | Column, level, idx) -> Column:
    column = lambda x: F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)
    return F.struct(column(tree).alias("tree"), column(level).cast("int").alias("level"), column(idx).cast("long").alias("idx"))


def _joined(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda k: k["h"]), "")


def _siblings(kids: Column, i: Column) -> Column:
    return F.struct(_joined(F.slice(kids, 1, i)).alias("left"), _joined(F.slice(kids, i + 2, FAN)).alias("right"))


def climb(rows: DataFrame, extra: tuple[str, ...] = ()) -> tuple[DataFrame | None, DataFrame, list[DataFrame]]:
    """From (tree, idx, total, h, *extra): the first level's runs, the trees' last nodes
    (tree, level, h), and the nodes between them, by level."""
    most, level, first, tops, hung = rows.agg(F.max("total")).first()[0] or 0, 0, None, [], []
    while most > 1:
        kid = F.struct("idx", "h", *(extra if level == 0 else ()))
        runs = staged(rows.where("total > 1").groupBy("tree", F.expr(f"idx div {FAN}").alias("run"))
                      .agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.first("total").alias("total")))
        tops.append(rows.where("total = 1").select("tree", F.lit(level).alias("level"), "h"))
        if level:
            hung.append(_hung(runs, level))
        first = first if level else runs
        rows = runs.select("tree", F.col("run").alias("idx"), F.expr(f"(total + {FAN - 1}) div {FAN}").alias("total"),
                           digest(_joined(F.col("kids"))).alias("h"))
        most, level = -(-most // FAN), level + 1
    tops.append(rows.select("tree", F.lit(level).alias("level"), "h"))
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return first, out, hung


def jumped(nodes: DataFrame, levels: int) -> DataFrame:
    """(id, path): each node's segments up to the root, by doubling the distance to the ancestor it points at."""
    nodes, done = staged(nodes), 1
    while done < levels:
        above = nodes.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("more"))
        far = (nodes.where("up IS NOT NULL").join(above, "up")
               .select("id", F.col("next").alias("up"), F.concat("path", "more").alias("path")))
        nodes = staged(far.unionByName(nodes.where("up IS NULL")))
        done *= 2
    return nodes.select("id", "path")


def proofs(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, path, folded_root, verified) of every row; ``path``
    holds the digests left and right of the way to the root, level by level."""
    rows = placed(leaves(docs, tampered), "doc_id", "leaf").withColumnRenamed("leaf", "h")
    rows = staged(rows)
    runs, subroots, inner = climb(rows, ("doc_id", "other"))
    subroots = staged(subroots.withColumnRenamed("tree", "of"))
    over = placed(subroots.select(F.lit(TOP).alias("tree"), "of", "level", "h"), "of").withColumnRenamed("level", "depth")
    over = staged(over)
    top_runs, root, upper = climb(over, ())
    roots = root.select("h").collect()                   # one row, or none of an empty table
    root_at = root.select("level").first()
    high = root_at[0] if root_at else 0
    links = [over.select(node("of", "depth", 0 * F.col("idx")).alias("id"), node(F.lit(TOP), 0, "idx").alias("up"),
                         F.expr("cast(array() AS array<struct<left: string, right: string>>)").alias("path"))]
    links += [_hung(top_runs, 0)] if top_runs is not None else []
    nodes = links[0]
    for n in [*links[1:], *inner, *upper]:
        nodes = nodes.unionByName(n)
    # the root points nowhere, and those just below it point beyond it
    last = node(F.lit(TOP), high, F.lit(0))
    nodes = nodes.withColumn("up", F.when(F.col("up") != last, F.col("up")))
    depth = (over.agg(F.max("depth")).first()[0] or 0) + 1 + high
    paths = jumped(nodes, depth)
    empty = F.expr("cast(array() AS array<struct<left: string, right: string>>)")
    lone = rows.where("total = 1").select(node("tree", 0, F.lit(0)).alias("id"), "tree", F.array(
        F.struct("idx", "h", "doc_id", "other")).alias("kids"), "total")
    parents = lone if runs is None else runs.select(node("tree", 1, "run").alias("id"), "tree", "kids", "total").unionByName(lone)
    leaf = (parents.join(paths, "id").select("tree", "total", "path", F.posexplode("kids").alias("i", "kid"), "kids")
            .select("tree", "kid.doc_id", F.col("kid.h").alias("leaf"), "kid.other",
                    F.concat(F.when(F.col("total") > 1, F.array(_siblings(F.col("kids"), F.col("i")))).otherwise(empty), "path").alias("path")))
    leaf = leaf.join(_small(subroots.select(F.col("of").alias("tree"), F.col("h").alias("subroot"))), "tree")
    folded = F.aggregate("path", F.coalesce("other", "leaf"), lambda h, s: digest(s["left"], h, s["right"]))
    out = leaf.select("doc_id", "leaf", "subroot", F.lit(roots[0].h if roots else None).cast("string").alias("root"),
                      digest(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")).alias("proof_sha256"),
                      "path", folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 of the decimal id, bit by bit: each byte is xor-ed in and then shifted out eight times.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""


def _field_sql(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(text if c == "text" else c) for c in COLUMNS) + ")"


_SIBLINGS_SQL = f"""coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, idx // {FAN} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, lvl, idx // {FAN} ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r"""

PROOFS_SQL = f"""
    WITH RECURSIVE base AS (
        SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql('text')} AS leaf,
               CASE WHEN {_CRC} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS other
        FROM documents),
    rows_ AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS total
        FROM base),
    low(tree, lvl, idx, h, total) AS (
        SELECT tree, 0, idx, leaf, total FROM rows_
        UNION ALL
        SELECT tree, lvl + 1, idx // {FAN}, sha256(string_agg(h, '' ORDER BY idx)), (total + {FAN - 1}) // {FAN}
        FROM low WHERE total > 1 GROUP BY tree, lvl, idx // {FAN}, total),
    subroots AS (SELECT tree, lvl, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS total FROM low WHERE total = 1),
    high(tree, lvl, idx, h, total) AS (
        SELECT '{TOP}', 0, idx, h, total FROM subroots
        UNION ALL
        SELECT tree, lvl + 1, idx // {FAN}, sha256(string_agg(h, '' ORDER BY idx)), (total + {FAN - 1}) // {FAN}
        FROM high WHERE total > 1 GROUP BY tree, lvl, idx // {FAN}, total),
    steps AS (
        SELECT tree, lvl, idx, total, {_SIBLINGS_SQL} FROM low
        UNION ALL
        SELECT tree, lvl, idx, total, {_SIBLINGS_SQL} FROM high),
    way(leaf_tree, leaf_idx, tree, lvl, idx, sides, n, h) AS (
        SELECT tree, idx, tree, 0, idx, '', 0, coalesce(other, leaf) FROM rows_
        UNION ALL
        SELECT w.leaf_tree, w.leaf_idx, CASE WHEN s.total > 1 THEN s.tree ELSE '{TOP}' END, CASE WHEN s.total > 1 THEN s.lvl + 1 ELSE 0 END,
               CASE WHEN s.total > 1 THEN s.idx // {FAN} ELSE u.idx END, s.l || s.r, w.n + 1,
               CASE WHEN s.total > 1 THEN sha256(s.l || w.h || s.r) ELSE w.h END
        FROM way w JOIN steps s ON w.tree = s.tree AND w.lvl = s.lvl AND w.idx = s.idx LEFT JOIN subroots u ON u.tree = s.tree
        WHERE s.total > 1 OR s.tree <> '{TOP}'),
    folded AS (
        SELECT leaf_tree, leaf_idx, arg_max(h, n) AS folded_root, sha256(string_agg(sides, '' ORDER BY n)) AS proof_sha256
        FROM way GROUP BY leaf_tree, leaf_idx)
    SELECT r.doc_id, r.leaf, u.h AS subroot, t.h AS root, f.proof_sha256, f.folded_root, f.folded_root = t.h AS verified
    FROM rows_ r JOIN folded f ON r.tree = f.leaf_tree AND r.idx = f.leaf_idx
    JOIN subroots u ON u.tree = r.tree, high t WHERE t.total = 1"""
