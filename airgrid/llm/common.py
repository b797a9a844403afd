"""What several operators share: table reading, the held-out fold, Arrow batches cut to a size."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of characters outside blank and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts that one step inside a task handles together, in bytes; a longer text is a step of its own.
STEP_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the third of documents that no model learns from; false where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """True where labels may be learned from; false where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` doesn't have (names compare without case)."""
    name, taken = f"__{stem}", {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def steps(batches, column: str, limit: int = STEP_BYTES):
    """Arrow batches cut so that `column` holds about `limit` bytes in each, however long its texts are."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin = held = 0
        for end, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(begin, end - begin)
                begin, held = end, 0
            held += int(size)
        yield batch.slice(begin)


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of "name kind, name kind" for the kinds that tasks return."""
    return pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, ddl.split(", "))])


#: A bitmap of hashed ids has so many words of 64 bits at most, whatever the number of ids.
BITMAP_WORDS = 1 << 19


def perhaps_in(rows: DataFrame, column: str, ids: DataFrame, inside: bool = True) -> DataFrame:
    """`rows` whose `column` (long) may be in `ids` (one column), or with `inside` false all others: what a bitmap of
    BITMAP_WORDS words (8 MB at most, so it can be sent everywhere) tells. Some that may be in are not, so an exact join
    must follow; this spares it the other rows."""
    size = BITMAP_WORDS * 64
    places = ids.select(F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(size)).alias("p"))
    words = places.selectExpr("p div 64 as b_word", "shiftleft(1L, cast(p % 64 as int)) as bit").groupBy("b_word").agg(F.bit_or("bit").alias("b_bits"))
    name = fresh(rows, "place")
    marked = rows.withColumn(name, F.pmod(F.xxhash64(F.col(column)), F.lit(size)))
    found = marked.join(F.broadcast(words), F.expr(f"{name} div 64") == words["b_word"], "left")
    may = F.coalesce(F.expr(f"(b_bits & shiftleft(1L, cast({name} % 64 as int))) <> 0"), F.lit(False))
    return found.where(may == F.lit(inside)).select(*[marked[c] for c in rows.columns])
