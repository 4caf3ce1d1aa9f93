"""Shards along a Hilbert curve, with DataFrame functions only.

Three metadata dimensions (size, source, language) are quantised to BITS bits each, so every document lies in one of
2^(3 * BITS) cells; cells are ordered by their index on the Hilbert curve and the ordered rows are cut into runs whose
counts differ by one at most. Shards then cover compact boxes of the metadata space, and a filter on any of the
dimensions prunes files by their minima and maxima.

The order within a cell is that of a hash of the document, so a cell of any number of rows is dealt over sub-buckets
and no task orders more than a bounded share. Ranks come from counts by cell and sub-bucket.

Copies of a text have places of their own: the law `rows` holds a shard to 1/SHARDS of all rows, while a group of equal texts may be
larger than that, so equal texts are not kept in one shard (of one size, source and language they share a cell of the curve, and
so neighbouring shards).

Sources and languages are ranked in one task each, which holds a row for each distinct value.

Defined results: a NULL text has 8 bytes and CRC 0; NULL sources and languages take the last code. Repeated rows get slots
of their own; a NULL doc_id is hashed as such. An empty table stays empty. Very long texts count whole. Other columns are not
read; write_shards() writes them as they are, whatever their names.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.common import columns_of, free_name, sized, written

BITS = 4
DIMENSIONS = 3
SHARDS = 24
#: Rows that one sub-bucket of a cell should hold at most, and the most sub-buckets of a cell.
BUCKET_ROWS = 20_000
MIN_SUB, MAX_SUB = 64, 65_536
#: Rows of a file of a shard.
FILE_ROWS = 1_000_000


def hilbert_steps(bits: int = BITS, n: int = DIMENSIONS) -> list[tuple[int, int]]:
    """(bit mask, axis) of the folding steps, from the highest bit down."""
    return [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]


def hilbert_index(axes: Column, bits: int = BITS, n: int = DIMENSIONS) -> Column:
    """The index on the n-dimensional Hilbert curve of an array of n coordinates of so many bits.

    The coordinates are folded axis by axis (invert, or exchange with the first axis), then turned into Gray code, whose
    bits interleave to the index.
    """
    steps = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in hilbert_steps(bits, n)])

    def fold(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        here = F.get(x, s["i"])
        swap = (F.get(x, F.lit(0)).bitwiseXOR(here)).bitwiseAND(low)
        high = here.bitwiseAND(s["q"]) != 0
        return F.transform(
            x,
            lambda v, j: F.when(high, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
                F.when(s["i"] == 0, v).when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap)).otherwise(v)
            ),
        )

    folded = F.aggregate(steps, axes, fold)
    # Gray code: each axis takes the exclusive or of all up to it; then a correction from the last axis's bits.
    gray = lambda x: F.transform(x, lambda v, j: F.aggregate(F.slice(x, F.lit(1), j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))
    bit_masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    fix = lambda x: F.aggregate(bit_masks, F.lit(0), lambda t, q: F.when(F.get(x, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
    final = F.transform(F.array(gray(folded)), lambda x: F.transform(x, lambda v: v.bitwiseXOR(fix(x))))
    order = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    interleave = lambda x: F.aggregate(order, F.lit(0), lambda a, s: F.shiftleft(a, 1).bitwiseOR(F.call_function("shiftright", F.get(x, s["i"]), s["b"]).bitwiseAND(F.lit(1))))
    return F.get(F.transform(final, interleave), F.lit(0))


def _codes(rows: DataFrame, column: str) -> DataFrame:
    """(column, code): the values' places in code-point order, scaled to BITS bits; NULL last. One row for each value."""
    values = rows.select(column).distinct()
    place = F.row_number().over(Window.orderBy(F.col(column).isNull(), F.col(column))) - 1
    scaled = F.floor(place * F.lit(1 << BITS) / F.greatest(F.count("*").over(Window.partitionBy()), F.lit(1 << BITS)))
    return values.select(F.col(column).alias(f"_{column}"), scaled.cast("int").alias(f"_{column}_code"))


def fine_hash(doc_id: Column, crc: Column, size: Column) -> Column:
    """A hash of a document, below 2^60: the first 15 hexadecimal digits of an MD5."""
    text = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), crc.cast("string"), size.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def placed(docs: DataFrame, shards: int = SHARDS, whole: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot[, row]) of every row; whole adds the row itself as a struct."""
    body = F.coalesce("text", F.lit("")).cast("binary")
    row = [F.struct(*columns_of(docs)).alias("row")] if whole else []
    rows = written(docs.select("doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), "source", "lang", *row))
    coded = rows
    for c in ("source", "lang"):
        codes = sized(written(_codes(rows, c)))
        coded = coded.join(codes, coded[c].eqNullSafe(codes[f"_{c}"])).drop(f"_{c}")
    size_code = F.least(F.greatest(F.floor(F.log2("size")) - 3, F.lit(0)), F.lit((1 << BITS) - 1)).cast("int")
    total = rows.count()
    sub_count = max(MIN_SUB, min(MAX_SUB, total // BUCKET_ROWS))
    carried = ["row"] if whole else []
    keyed = coded.select(
        "doc_id", "size", "text_crc32", hilbert_index(F.array(size_code, F.col("_source_code"), F.col("_lang_code"))).alias("curve"),
        fine_hash(F.col("doc_id"), F.col("text_crc32"), F.col("size")).alias("fine"), *carried,
    ).withColumn("sub", F.pmod("fine", F.lit(sub_count)).cast("int"))
    keyed = written(keyed)
    counts = keyed.groupBy("curve", "sub").agg(F.count("*").alias("n"))
    cells = counts.groupBy("curve").agg(F.sum("n").alias("cell_n"))
    upto = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cell_base = cells.select("curve", F.coalesce(F.sum("cell_n").over(upto), F.lit(0)).alias("cell_base"))
    within = Window.partitionBy("curve").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("sub_base", F.coalesce(F.sum("n").over(within), F.lit(0))).join(cell_base, "curve").select("curve", "sub", (F.col("cell_base") + F.col("sub_base")).alias("base"))
    ranked = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("curve", "sub").orderBy("fine", "doc_id", "text_crc32", "size")) - 1)
    place = ranked.join(bases, ["curve", "sub"]).withColumn("g", F.col("base") + F.col("rank"))
    shard = F.expr(f"g * {shards} div {max(total, 1)}")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return place.withColumn("shard", shard.cast("int")).select("doc_id", "size", "text_crc32", "curve", "shard", (F.col("g") - start).alias("slot"), *carried)


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """placed() under the law `rows`: counts of shards differ by one at most."""
    return placed(docs, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, rows_per_file: int = FILE_ROWS) -> str:
    """docs, all columns, as a Parquet folder for each shard, in files of so many rows in curve order; the folders' column is returned.

    Rows travel with their place, so repeated rows and ids stay what they are.
    """
    name = free_name(docs, "_shard")
    place = placed(docs, shards, whole=True).select("row", "shard", "slot", F.floor(F.col("slot") / rows_per_file).alias("file"))
    ordered = place.repartition("shard", "file").sortWithinPartitions("shard", "slot")
    own = [F.col("row.`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns]
    ordered.select(*own, F.col("shard").alias(name)).write.option("maxRecordsPerFile", rows_per_file).partitionBy(name).parquet(path)
    return name


def hilbert_cell(axes: list[int], bits: int = BITS) -> int:
    """hilbert_index() of one cell in plain Python, for the oracle."""
    x, n = list(axes), len(axes)
    for q, i in hilbert_steps(bits, n):
        if x[i] & q:
            x[0] ^= q - 1
        else:
            swap = (x[0] ^ x[i]) & (q - 1)
            x[0] ^= swap
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    fix = 0
    for b in range(bits - 1, 0, -1):
        if x[-1] >> b & 1:
            fix ^= (1 << b) - 1
    return int("".join(str((v ^ fix) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


_SIDE = 1 << BITS
_CURVE = [hilbert_cell([i // _SIDE // _SIDE, i // _SIDE % _SIDE, i % _SIDE]) for i in range(_SIDE**3)]
_CODE = f"""least(floor((row_number() OVER (ORDER BY {{0}} IS NULL, {{0}}) - 1) * {_SIDE} / greatest(count(*) OVER (), {_SIDE})), {_SIDE - 1})::INT AS {{0}}_code
  FROM (SELECT DISTINCT {{0}} FROM documents)"""
#: CRC-32 in SQL: the table of the polynomial is generated, and bytes come from the text's hexadecimal form.
_CRC_TABLE = [functools.reduce(lambda c, _: (c >> 1) ^ (0xEDB88320 if c & 1 else 0), range(8), i) for i in range(256)]
ORACLE = f"""
WITH b AS (SELECT doc_id, source, lang, hex(encode(coalesce(text, ''))) AS h FROM documents),
d AS (SELECT doc_id, source, lang, length(h) // 2 + 8 AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, ({_CRC_TABLE}::BIGINT[])[xor(c & 255, x) + 1])), 4294967295::BIGINT) AS text_crc32 FROM b),
s AS (SELECT source, {_CODE.format("source")}),
l AS (SELECT lang, {_CODE.format("lang")}),
k AS (SELECT doc_id, size, text_crc32, ({_CURVE}::INT[])[(least(greatest(floor(log2(size)) - 3, 0), {_SIDE - 1}) * {_SIDE**2} + source_code * {_SIDE} + lang_code)::INT + 1] AS curve,
  ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, 'null'), text_crc32::VARCHAR, size::VARCHAR)), 1, 15))::BIGINT AS fine
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN l ON d.lang IS NOT DISTINCT FROM l.lang),
t AS (SELECT count(*) AS total FROM documents),
g AS (SELECT *, row_number() OVER (ORDER BY curve, fine % greatest({MIN_SUB}, least({MAX_SUB}, total // {BUCKET_ROWS})), fine, doc_id NULLS FIRST, text_crc32, size) - 1 AS g FROM k, t),
p AS (SELECT *, (g * {SHARDS} // total)::INT AS shard FROM g)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard, (g - (shard * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard, curve FROM p
"""
