"""Merkle manifest of a table by nested-struct rollup.

Rows of a key are numbered 0, 1, ... in their order.  The number's lowest
digits (base 16) are grouped away one after another: the rows that differ in
the lowest digit only are collected, in digit order, as the children of a
struct that holds the hashes of the binary tree over them; these structs are
the children of the next digit's.  After two digits a block of at most 256
rows is one nested struct and its hash one row of the tier above, where the
same happens, until every key has one block.  Nothing grows with the key.

Proofs go down the same way: a block's struct is transformed to one array of
rows, each with the siblings inside its block, followed by the block's own
siblings above, and exploded.  What a block takes from the tier above (one row
a block) is grouped into the block's row; rows are never joined for proofs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, stored

#: digits of base 2 ** WIDTH grouped away in a block
WIDTH, DIGITS = 4, 2
BLOCK_BITS = WIDTH * DIGITS
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SIDES = "array<struct<left:boolean,sibling:string>>"


def leaf_hash(*columns):
    """SHA-256 of the values: ``-`` if null, else byte count, ``:``, value."""
    field = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*field), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and, where a copy with n_chars + 1 is to be tried,
    its leaf (``tampered``; else null).  Reads each text once."""
    named = {c: F.col(c).cast("string") for c in LEAF_COLUMNS}
    changed = {**named, "n_chars": (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")}
    tried = F.pmod(F.crc32(named["doc_id"].cast("binary")), F.lit(7)) == 0
    return docs.select(
        "doc_id", named["lang"].alias("lang"), leaf_hash(*named.values()).alias("leaf"),
        F.when(tried & F.col("n_chars").isNotNull(), leaf_hash(*changed.values())).alias("tampered"))


def ordered(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """``df`` with ``pos`` (0-based among the rows of equal ``key`` in ``order``)
    and ``n`` (rows of the key).

    Rows are dealt by ranges of (key, order), so a key with most of the rows
    spreads over many tasks; a range's rows are shifted by the key's rows in
    earlier ranges (one small row per range and key).  Keys are not null.
    """
    by = [F.col(k) for k in key] + order
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by)
    x = stored(dealt.select("*", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().alias("__at")), "ordered")
    parts = x.groupBy(*key, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    before = Window.partitionBy(*key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1) if key else \
        Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*key, "__range", "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
                         F.sum("__rows").over(Window.partitionBy(*key)).alias("n"))
    return (x.join(parts, [*key, "__range"])
            .select(*df.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("pos"), "n"))


def _digit(rows: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Group one digit away: ``rows`` has ``digit`` and ``node`` (struct with
    h) per child; the result has ``node`` = (h, levels, kids) per parent.
    ``levels`` are the hashes of the binary tree over the children, from the
    children's own up; a tree of n nodes stops growing at one node, so level k
    of the whole tree hashes only where 2 ** k < n."""
    x = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("digit", "node"))).alias("kids"))
    x = x.withColumn("kids", F.transform("kids", lambda k: k.node)).withColumn("l0", F.transform("kids", lambda k: k.h))
    for k in range(WIDTH):
        low = F.col(f"l{k}")
        pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size(low) - 1) / 2).cast("int")),
                            lambda i: F.sha2(F.concat(F.get(low, i * 2), F.coalesce(F.get(low, i * 2 + 1), F.lit(""))), 256))  # noqa: B023
        x = x.withColumn(f"l{k + 1}", F.when(F.lit(1 << (level + k)) < F.col("n"), pairs).otherwise(low))
    return x.select(*keys, F.struct(F.get(f"l{WIDTH}", F.lit(0)).alias("h"),
                                    F.array(*[F.col(f"l{k}") for k in range(WIDTH)]).alias("levels"), "kids").alias("node"))


def blocks(nodes: DataFrame, key: list[str]) -> DataFrame:
    """One nested struct per (key, block) of ``nodes`` (key, pos, n, h, body)."""
    digits = [f"__d{d}" for d in range(DIGITS)]
    x = nodes.select(*key, "n", F.shiftright("pos", BLOCK_BITS).alias("block"), F.struct("h", "body").alias("node"),
                     *[F.shiftright("pos", WIDTH * d).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int").alias(c) for d, c in enumerate(digits)])
    # one shuffle on what all groupings share: each later one finds its rows in place
    x = x.repartition(*key, "n", "block")
    for d, c in enumerate(digits):
        x = _digit(x.withColumnRenamed(c, "digit"), [*key, "n", "block", *digits[d + 1:]], WIDTH * d)
    return x


def _sides(levels, i, level: int):
    """Siblings of child i at each level of a digit, where the tree has one."""
    none = F.array().cast(SIDES)
    return F.concat(*[
        F.when(F.lit(1 << (level + k)) < F.col("n"),
               F.array(F.struct((F.shiftright(i, k).bitwiseAND(F.lit(1)) == 1).alias("left"),
                                F.get(F.get(levels, F.lit(k)), F.shiftright(i, k).bitwiseXOR(F.lit(1))).alias("sibling")))).otherwise(none)
        for k in range(WIDTH)])


def proofs(built: DataFrame, above: DataFrame, key: list[str]) -> DataFrame:
    """key, pos, body, h, path, top of every node: ``built`` are its blocks,
    ``above`` has (key, block, path, top) of each block."""
    both = built.select(*key, "block", "n", "node", F.lit(None).cast(SIDES).alias("path"), F.lit(None).cast("struct<subroot:string,root:string>").alias("top")) \
        .unionByName(above.select(*key, "block", F.lit(None).cast("long").alias("n"), F.lit(None).cast(built.schema["node"].dataType).alias("node"), "path", "top"))
    whole = both.groupBy(*key, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "top")])

    def inside(node, place, path, d):
        if d < 0:
            return F.array(F.struct(node.body.alias("body"), node.h.alias("h"), place.alias("place"), path.alias("path")))
        return F.flatten(F.transform(node.kids, lambda kid, i: inside(
            kid, place * (1 << WIDTH) + i, F.concat(_sides(node.levels, i, WIDTH * d), path), d - 1)))

    rows = whole.select(*key, "block", "top", F.explode(inside(F.col("node"), F.lit(0), F.col("path"), DIGITS - 1)).alias("r"))
    return rows.select(*key, (F.col("block") * (1 << BLOCK_BITS) + F.col("r.place")).alias("pos"), "r.body", "r.h", "r.path", "top")


def _climb(nodes: DataFrame, key: list[str], largest: int, name: str) -> list[DataFrame]:
    """Blocks of every tier, the lowest first; the last has one per key."""
    tiers = []
    while True:
        tiers.append(stored(blocks(nodes, key), f"{name}{len(tiers)}"))
        if largest <= 1 << BLOCK_BITS:
            return tiers
        largest = -(-largest >> BLOCK_BITS)
        nodes = tiers[-1].select(*key, F.col("block").alias("pos"), F.ceil(F.col("n") / (1 << BLOCK_BITS)).cast("long").alias("n"),
                                 F.col("node.h").alias("h"), F.struct("block").alias("body"))


def _descend(tiers: list[DataFrame], above: DataFrame, key: list[str]) -> DataFrame:
    """Proofs of the lowest tier's nodes; ``above`` holds each key's."""
    found = above.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        found = proofs(tier, found, key).withColumn("block", F.col("pos"))
    return found.drop("block")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of
    every row of ``docs``, as the tree over its languages has them.

    A null is ``-`` in its leaf; a null doc_id comes first in its language and
    is never tampered with; rows with equal ids lie in the order of their
    leaves, equal rows all appear.  An empty text is ``0:``.  A null language
    is one of its own, before all others.  An empty table gives no rows.
    Columns beyond the five hashed ones are not read.
    """
    made = leaves(docs)
    at = stored(made.select("*", F.col("lang").isNotNull().cast("int").alias("known"), F.coalesce("lang", F.lit("")).alias("tongue"))
                .drop("lang"), "leaves")
    key = ["known", "tongue"]
    rows = ordered(at, key, [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.monotonically_increasing_id()])
    nodes = rows.select(*key, "pos", "n", F.col("leaf").alias("h"), F.struct("doc_id", "tampered").alias("body"))
    largest = at.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    inner = _climb(nodes, key, largest, "tier")

    subroots = inner[-1].select(*key, F.col("node.h").alias("h"))
    tongues = stored(subroots, "subroots")
    outer_nodes = ordered(tongues, [], [F.col(k) for k in key]).select("pos", "n", "h", F.struct(*key).alias("body"))
    outer = _climb(outer_nodes, [], tongues.count(), "top")
    root = outer[-1].select(F.array().cast(SIDES).alias("path"),
                            F.struct(F.lit(None).cast("string").alias("subroot"), F.col("node.h").alias("root")).alias("top"))
    per_tongue = _descend(outer, root, []).select(
        "body.*", "path", F.struct(F.col("h").alias("subroot"), F.col("top.root").alias("root")).alias("top"))

    found = _descend(inner, per_tongue, key)
    step = lambda acc, s: F.sha2(F.concat(F.when(s.left, F.coalesce(s.sibling, F.lit(""))).otherwise(""), acc,
                                          F.when(s.left, "").otherwise(F.coalesce(s.sibling, F.lit("")))), 256)
    return found.select(
        F.col("body.doc_id").alias("doc_id"), F.col("h").alias("leaf"), "top.subroot", "top.root",
        F.sha2(F.array_join(F.transform("path", lambda s: F.coalesce(s.sibling, F.lit(""))), ""), 256).alias("proof_sha256"),
        F.aggregate("path", F.coalesce("body.tampered", "h"), step).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a subtree per language."""
    return manifest(read(spark, sf_dir, "documents"))


_CRC = """xor(list_reduce([ord(substr(s, i, 1)) FOR i IN range(1, 1 + length(s))],
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"""

OP11_SQL = """
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END, v) ORDER BY v) AS t
  FROM (SELECT unnest(range(256)) AS v)
), ids AS (
  SELECT s, @CRC@ % 7 = 0 AS tried FROM (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL), crc
), f AS (
  SELECT d.doc_id, lang,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS b,
    coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS b2,
    coalesce(strlen(text) || ':' || text, '-') AS c, coalesce(ids.tried, false) AS tried
  FROM documents d LEFT JOIN ids ON CAST(d.doc_id AS VARCHAR) = ids.s
), l AS MATERIALIZED (
  SELECT doc_id, lang, sha256(a || b || c) AS leaf, CASE WHEN tried THEN sha256(a || b2 || c) ELSE sha256(a || b || c) END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(a || b || c)) - 1 AS pos FROM f
), tree AS (
  SELECT lang, 0 AS lvl, pos, leaf AS h FROM l
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS m FROM tree) WHERE m > 1 GROUP BY lang, lvl, pos // 2
), height AS (
  SELECT lang, max(lvl) AS levels FROM tree GROUP BY lang
), subroots AS MATERIALIZED (
  SELECT t.lang, t.h, hg.levels, row_number() OVER (ORDER BY encode(t.lang) NULLS FIRST) - 1 AS pos
  FROM tree t JOIN height hg ON t.lang IS NOT DISTINCT FROM hg.lang AND t.lvl = hg.levels
), crown AS (
  SELECT 0 AS lvl, pos, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS m FROM crown) WHERE m > 1 GROUP BY lvl, pos // 2
), top AS (
  SELECT max(lvl) AS levels, max_by(h, lvl) AS root FROM crown
), steps AS (
  SELECT l.lang, l.pos, s.step,
    CASE WHEN step < r.levels THEN (l.pos >> step) % 2 ELSE (r.pos >> (step - r.levels)) % 2 END AS odd,
    coalesce(CASE WHEN step < r.levels THEN t.h ELSE c.h END, '') AS sibling
  FROM l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang CROSS JOIN top
  JOIN (SELECT unnest(range(100)) AS step) s ON s.step < r.levels + top.levels
  LEFT JOIN tree t ON s.step < r.levels AND t.lang IS NOT DISTINCT FROM l.lang AND t.lvl = s.step AND t.pos = xor(l.pos >> s.step, 1)
  LEFT JOIN crown c ON s.step >= r.levels AND c.lvl = s.step - r.levels AND c.pos = xor(r.pos >> (s.step - r.levels), 1)
), path AS MATERIALIZED (
  SELECT lang, pos, list(struct_pack(odd := odd, sibling := sibling) ORDER BY step) AS p, string_agg(sibling, '' ORDER BY step) AS proof
  FROM steps GROUP BY lang, pos
), fold AS (
  SELECT l.lang, l.pos, 0 AS step, l.changed AS h FROM l
  UNION ALL
  SELECT f.lang, f.pos, f.step + 1, CASE WHEN p.p[f.step + 1].odd = 1 THEN sha256(p.p[f.step + 1].sibling || f.h) ELSE sha256(f.h || p.p[f.step + 1].sibling) END
  FROM fold f JOIN path p ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos AND f.step < len(p.p)
), folded AS (
  SELECT lang, pos, max_by(h, step) AS h FROM fold GROUP BY lang, pos
)
SELECT l.doc_id, l.leaf, r.h AS subroot, top.root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.h AS folded_root, f.h = top.root AS verified
FROM l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang CROSS JOIN top
JOIN folded f ON l.lang IS NOT DISTINCT FROM f.lang AND l.pos = f.pos
LEFT JOIN path p ON l.lang IS NOT DISTINCT FROM p.lang AND l.pos = p.pos
""".replace("@CRC@", _CRC)
