"""Order MinHash fingerprints, in DataFrame functions only.

A token is a word of at most WORD characters with the white space that follows; longer runs without
white space give one at every character, of the GRAIN characters from there on, so that an edit
changes only those near it. A k-mer is a token with its successor (nothing after the last), and its r-th
occurrence in the text is numbered r. A hash of (k-mer, r) deals the numbered k-mers into BINS; in
each bin the TAKE smallest are selected, put back into text order, and their tuple is hashed. Two
texts are as alike as the share of bins, filled in either, that agree. As tuples keep the order of
k-mers, the likeness follows edit distance, not only the set of k-mers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint, table

WORD, GRAIN = 24, 8
BINS = 32
TAKE = 2
#: Positions take the low bits of a packed number, hashes the rest, so that plain longs can be sorted.
PLACE = 24
EMPTY = "." * 8
#: Equal results that are written out in one place.
EQUALS = 1 << 16
NO_ID = -(2**63)


def fingerprint(df: DataFrame, text_col: str, name: str, place: int = PLACE) -> DataFrame:
    """Add `name`: BINS fields of 8 characters each, hex of the bin's hash or dots for an empty bin.

    Equal texts get equal fingerprints. A null or empty text has dots only. No rows are moved.
    In a text of 2^place tokens or more, neighbouring ones share a position, and the hash orders those of one.
    """
    t, k, s, f, h, q = (f"__{name}_{x}" for x in "tksfhq")
    mask = (1 << (63 - place)) - 1
    low = (1 << place) - 1
    width = 63 - place
    shift = width - BINS.bit_length() + 1  # the hash's top bits name the bin
    whole = rf"(?<!\\S)\\S{{1,{WORD}}}(?!\\S)\\s*"
    every = rf"(?=({whole}|\\S{{1,{GRAIN}}}\\s*|\\s+))(?:{whole}|\\S\\s*|\\s+)"
    text = f"coalesce({text_col}, '')"
    # without a long run the plain pattern gives the same tokens
    df = df.withColumn(t, F.expr(f"if({text} rlike '\\\\S{{{WORD + 1}}}', regexp_extract_all({text}, '{every}', 1), regexp_extract_all({text}, '\\\\S+\\\\s*|\\\\s+', 0))"))
    at = f"if(size({t}) <= {low}, i, cast(i div (1 + size({t}) div {low + 1}) as int))"
    # k-mers as packed (hash, place)
    df = df.withColumn(k, F.expr(f"sort_array(transform({t}, (x, i) -> shiftleft(xxhash64(x, coalesce(get({t}, i + 1), '')) & {mask}L, {place}) | {at}))"))
    # repeated k-mers stand together: the first of a run is numbered 1, the others by their distance from it
    new = f"i = 0 OR shiftrightunsigned({k}[i], {place}) <> shiftrightunsigned({k}[i - 1], {place})"
    df = df.withColumn(s, F.expr(f"filter({k}, (x, i) -> {new})"))
    df = df.withColumn(f, F.expr(f"if(size({s}) = size({k}), array(), filter(sequence(0, size({k})), i -> i = size({k}) OR {new}))"))
    number = lambda x, r: f"(shiftleft(xxhash64(shiftrightunsigned({x}, {place}), {r}) & {mask}L, {place}) | ({x} & {low}L))"
    first = f"transform({s}, x -> {number('x', '1')})"
    runs = f"filter(transform({f}, (a, i) -> struct(a, coalesce(get({f}, i + 1), a) AS b)), p -> p.b - p.a > 1)"
    later = f"flatten(transform({runs}, p -> transform(sequence(1, p.b - p.a - 1), j -> {number(f'{k}[p.a + j]', 'j + 1')})))"
    df = df.withColumn(h, F.expr(f"sort_array(if(size({f}) = 0, {first}, concat({first}, {later})))"))
    # bins are the top bits, so a bin's numbered k-mers stand together, smallest first
    bin_of = lambda x: f"shiftrightunsigned({x}, {place + shift})"
    df = df.withColumn(q, F.expr(f"filter({h}, (x, i) -> i < {TAKE} OR {bin_of(f'{h}[i - {TAKE}]')} <> {bin_of('x')})"))
    # the last selected entry of a bin makes the tuple, its members in text order
    member = lambda x: f"named_struct('p', {x} & {low}L, 'h', shiftrightunsigned({x}, {place}))"
    others = "".join(f", if(i >= {j} AND {bin_of(f'{q}[i - {j}]')} = {bin_of('x')}, {member(f'{q}[i - {j}]')}, null)" for j in range(1, TAKE))
    tuple_ = f"transform(sort_array(filter(array({member('x')}{others}), m -> m IS NOT NULL)), m -> m.h)"
    last = f"i = size({q}) - 1 OR {bin_of(f'{q}[i + 1]')} <> {bin_of('x')}"
    entry = f"named_struct('b', cast({bin_of('x')} AS int), 'v', lpad(lower(hex(hash({tuple_}) & 4294967295L)), 8, '0'))"
    entries = f"map_from_entries(filter(transform({q}, (x, i) -> if({last}, {entry}, null)), m -> m IS NOT NULL))"
    line = f"array_join(transform(sequence(0, {BINS - 1}), b -> coalesce(element_at(m, b), '{EMPTY}')), '')"
    return df.withColumn(name, F.expr(f"transform(array({entries}), m -> {line})[0]")).drop(t, k, s, f, h, q)


def likeness(a: str, b: str) -> Column:
    """Share of bins filled in either fingerprint that agree; 1 for two fingerprints without filled bins, null for a null one."""
    bins = f"transform(sequence(0, {BINS - 1}), b -> struct(substring({a}, 8 * b + 1, 8) AS x, substring({b}, 8 * b + 1, 8) AS y))"
    filled = f"filter({bins}, p -> p.x <> '{EMPTY}' OR p.y <> '{EMPTY}')"
    return F.expr(f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN null WHEN {a} = {b} THEN 1.0D ELSE size(filter({filled}, p -> p.x = p.y)) / cast(size({filled}) AS double) END")


def neighbours(keys: DataFrame, per_bucket: int = 100_000) -> DataFrame:
    """(kid, th, next_kid, next_th): each distinct key's successor by descending kid, then th; the last one's is the first.

    Keys are dealt into ranges of about per_bucket keys (or the root of their number, if that is more), ordered
    inside each, and the heads of the ranges join them up, so no task orders all keys or all of one id.
    """
    n = keys.count()
    parts = max(1, -(-n // max(per_bucket, int(n**0.5))))
    # written, so that both uses below see the same ranges
    placed = checkpoint(keys.repartitionByRange(parts, F.desc("kid"), F.asc("th")).withColumn("bucket", F.spark_partition_id()))
    w = Window.partitionBy("bucket").orderBy(F.desc("kid"), "th")
    head = placed.groupBy("bucket").agg(F.max(F.struct("kid", (-1 - F.col("th")).alias("back"))).alias("m"))
    head = head.select("bucket", F.struct(F.col("m.kid").alias("kid"), (-1 - F.col("m.back")).alias("th")).alias("head"))
    up = Window.orderBy("bucket")  # of `parts` rows
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = head.select("bucket", F.coalesce(F.lead("head").over(up), F.first("head").over(whole)).alias("then"))
    out = placed.withColumn("next", F.lead(F.struct("kid", "th")).over(w)).join(F.broadcast(head), "bucket")  # the root of the number of keys at most, or one for 100,000 keys
    return out.select("kid", "th", F.coalesce("next", "then").alias("next")).select("kid", "th", F.col("next.kid").alias("next_kid"), F.col("next.th").alias("next_th"))


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", equals: int = EQUALS) -> DataFrame:
    """Fingerprints of each text and of its edited text: the last third replaced by the start of the next document.

    Null texts count as empty. A null id counts as the smallest long. Rows of equal id are ordered by a hash of
    their texts; rows equal in id and text share one place and are folded before they are moved, then give a result
    each. A table of one row is its own next document; an empty one gives an empty one. Other columns of the input
    are not carried.
    """
    base = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("kid"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("th", F.xxhash64("text"))
    keys = checkpoint(base.select("kid", "th", F.char_length("text").cast("long").alias("n_chars")).distinct())
    need = keys.join(neighbours(keys.select("kid", "th")), ["kid", "th"]).select(F.col("kid").alias("to_kid"), F.col("th").alias("to_th"), F.floor(F.col("n_chars") / 3).cast("int").alias("need"), F.col("next_kid").alias("kid"), F.col("next_th").alias("th"))
    # both joins below read the same columns of this exchange, so that it is made once
    base = fingerprint(base, "text", "fingerprint").groupBy("kid", "th").agg(F.first("text").alias("text"), F.first("fingerprint").alias("fingerprint"), F.count("*").alias("n"))
    given = base.where("n > 0").join(need.hint("merge"), ["kid", "th"]).select(F.col("to_kid").alias("kid"), F.col("to_th").alias("th"), F.expr("substring(text, 1, need)").alias("start"), F.col("fingerprint").alias("next_fingerprint"))
    both = base.join(given.hint("merge"), ["kid", "th"]).withColumn("n_chars", F.char_length("text").cast("long"))
    both = both.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 3 AS int)), start)"))
    both = fingerprint(both.select(F.when(F.col("kid") != NO_ID, F.col("kid")).alias("doc_id"), "n", "n_chars", "edited", "fingerprint", "next_fingerprint"), "edited", "edited_fingerprint")
    made = both.select("doc_id", "n", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"))
    # equal rows are written out again in blocks that lie apart
    blocks = made.withColumn("block", F.explode(F.expr(f"sequence(0, (n - 1) div {equals})"))).repartition("doc_id", "n_chars", "block")
    return blocks.withColumn("nth", F.explode(F.expr(f"sequence(block * {equals}, least(n, (block + 1) * {equals}) - 1)"))).drop("n", "block", "nth")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all whole `documents` and their edited texts."""
    return edited(table(spark, sf_dir, "documents"))
