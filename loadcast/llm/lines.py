"""Line dedup with a log-template tree, in DataFrame operations only.

A line's tokens are split at spaces; tokens with a digit are variable fields
(``<*>``), unless more than half of the line would be.  The tree has a fixed
depth: token count, then the first ``lead`` tokens.  A leaf holds any number of
templates:

- every masked text is one;
- every text with one token after the leading ones left open is one, if lines of
  several texts fit it (so a family is found whatever else shares its leaf);
- for lines of at least ``merge_tokens`` tokens, the text of the tokens that
  most texts of the leaf share at their positions, the others open; texts that
  agree with ``similarity`` of all positions are its instances.

A template that recurs in more than one document is kept in the document with
the smallest id (every occurrence there) and dropped from all others.  Lines of
fewer than ``min_tokens`` tokens (text without spaces, too) have no variable
fields: they recur as they stand.  Blank lines are never dropped.

The text of a line is read once for its hashes and, where its leaf has several
texts, from one place more.  Hashes travel: 128 bits of the masked line and 64 of its leaf; 64 bits of each
token only where a leaf has several texts.  A text with one token open is the
XOR of its positions' hashes (128 bits) without that position, so a line takes
time in proportion to its length.  Everything before a shuffle is a partial
aggregate (smallest and largest document id), so a line that a third of all
documents share is one row a task.

Defined results: null text stays null, empty text empty; a document whose lines
all go keeps its row with empty text; rows without an id are left alone and
count for nothing; repeated rows (same id and text) are treated alike and do
not make their lines recur; an empty table gives an empty result; all columns
of the input are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import discard, stored, written

LEAD = 4
MIN_TOKENS = 5
MERGE_TOKENS = 8
SIMILARITY = 0.8
BROADCAST_ROWS = 500_000  # leaves (16 bytes) or lines (68 bytes) that may be broadcast
VARIABLE = "<*>"


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" ")))


def masked(line: Column) -> Column:
    """The line with its variable fields marked."""
    out = F.regexp_replace(line, "[^ ]*[0-9][^ ]*", VARIABLE)
    fields = (F.length(out) - F.length(F.replace(out, F.lit(VARIABLE)))) / len(VARIABLE)
    return F.when(line.rlike("[0-9]"), F.when(fields * 2 <= _spaces(line) + 1, out).otherwise(line)).otherwise(line)


def placed_lines(docs: DataFrame, *, lead: int = LEAD, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``(doc, version, pos, leaf, h1, h2)`` of every line of ``docs(doc,
    version, text)`` that is not blank; ``leaf`` is null for a line of few tokens."""
    rows = (docs.filter("doc is not null").select("doc", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .filter(F.btrim("line", F.lit(" \t\r")) != ""))
    rows = rows.withColumn("n_tokens", _spaces(F.col("line")) + 1)
    long = F.col("n_tokens") >= min_tokens
    rows = rows.withColumn("m", F.when(long, masked(F.col("line"))).otherwise(F.col("line")))
    return rows.select("doc", "version", "pos", F.when(long, F.xxhash64("n_tokens", F.substring_index("m", " ", lead))).alias("leaf"),
                       F.xxhash64("m").alias("h1"), F.xxhash64(F.lit(1), "m").alias("h2"))


def _shared_texts(docs: DataFrame, places: DataFrame, leaves: DataFrame, broadcast_rows: int) -> DataFrame:
    """``(leaf, n, h1, h2, low, high, codes)``: the texts of the leaves that
    several have, with their tokens, read from one place each."""
    few = F.broadcast if leaves.limit(broadcast_rows + 1).count() <= broadcast_rows else (lambda t: t)
    texts = (places.join(few(leaves), "leaf").groupBy("leaf", "n", "h1", "h2")
             .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.min(F.struct("doc", "version", "pos")).alias("at")))
    wanted = written(texts.select(F.col("at.doc").alias("d"), F.col("at.version").alias("v"), "at.pos", "leaf", "n", "h1", "h2", "low", "high"), "line-places")
    few = F.broadcast if wanted.limit(broadcast_rows + 1).count() <= broadcast_rows else (lambda t: t)
    lines = wanted.groupBy("d", "v").agg(F.collect_list(F.struct("pos", "leaf", "n", "h1", "h2", "low", "high")).alias("own"))
    held = docs.join(few(lines), (F.col("doc") == F.col("d")) & (F.col("version") == F.col("v")))
    picked = lambda lines: F.transform("own", lambda x: F.struct(x.alias("x"), F.get(lines, x["pos"]).alias("line")))
    # A variable, so that a text is split once, not once a line.
    found = held.select(F.explode(F.get(F.transform(F.array(F.split("text", "\n")), picked), F.lit(0))).alias("y")).select("y.x.*", "y.line")
    return (found.withColumn("codes", F.transform(F.split(masked(F.col("line")), " "), lambda t: F.xxhash64(t)))
            .dropDuplicates(["leaf", "h1", "h2"]).select("leaf", "n", "h1", "h2", "low", "high", "codes"))


def _one_open(shared: DataFrame, lead: int, similarity: float) -> DataFrame:
    """``(h1, h2, keep)`` of texts that agree with another in all but one token."""
    at = lambda seed, p, code: F.xxhash64(F.lit(seed), p, code)
    whole = [F.aggregate(F.transform("codes", lambda c, p: at(seed, p, c)), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)).alias(f"all{seed}")
             for seed in (0, 1)]
    texts = shared.filter(F.size("codes") - 1 >= similarity * F.size("codes")).select("leaf", "h1", "h2", "low", "high", *whole, "codes")
    fields = texts.select("leaf", "h1", "h2", "low", "high", "all0", "all1", F.posexplode("codes").alias("p", "code")).filter(F.col("p") >= lead)
    # The leaf and the open position are part of the template's 128 bits.
    open_at = lambda seed: F.col(f"all{seed}").bitwiseXOR(at(seed, F.col("p"), F.col("code"))).bitwiseXOR(F.xxhash64(F.lit(seed), "leaf", "p"))
    template = ["k0", "k1"]
    fields = fields.select(*[open_at(seed).alias(k) for seed, k in enumerate(template)], "h1", "h2", "low", "high")
    several = (fields.groupBy(*template).agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("keep"), F.max("high").alias("last"))
               .filter("n > 1 and keep < last").select(*template, "keep"))
    return fields.join(several, template).select("h1", "h2", "keep")


def _majority(shared: DataFrame, merge_tokens: int, similarity: float) -> DataFrame:
    """``(h1, h2, keep)`` of instances of the template that most of a leaf share."""
    long = shared.filter(F.size("codes") >= merge_tokens)
    votes = (long.select("leaf", "n", F.posexplode("codes").alias("at", "code")).groupBy("leaf", "n", "at", "code").count()
             .filter(F.col("count") * 2 > F.col("n")))
    constant = (votes.groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("at", "code"))).alias("constant"),
                                          F.count(F.lit(1)).alias("n_constant")))
    constant = constant.select("leaf", F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("constant"))),
                                                   lambda i: F.try_element_at("constant", i)).alias("fixed"), "n_constant")
    agree = F.aggregate(F.zip_with("codes", "fixed", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda a, x: a + x)
    instances = (long.join(constant, "leaf").filter(F.col("n_constant") >= similarity * F.size("codes"))
                 .filter(agree >= similarity * F.size("codes")).select("leaf", "h1", "h2", "low", "high"))
    merged = (instances.groupBy("leaf").agg(F.min("low").alias("keep"), F.max("high").alias("last"))
              .filter("keep < last").select("leaf", "keep"))
    return instances.join(merged, "leaf").select("h1", "h2", "keep")


def recurring_templates(docs: DataFrame, places: DataFrame, *, lead: int = LEAD, merge_tokens: int = MERGE_TOKENS,
                        similarity: float = SIMILARITY, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``(h1, h2, keep)`` of masked lines whose template recurs across
    documents; ``keep`` is the document that keeps it.  ``places`` are the
    ``placed_lines`` of ``docs``."""
    kinds, kept = stored(places.groupBy("leaf", "h1", "h2").agg(F.min("doc").alias("low"), F.max("doc").alias("high")), "line-templates")
    exact = kinds.filter("low < high").select("h1", "h2", F.col("low").alias("keep"))
    leaves = written(kinds.filter("leaf is not null").groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("a"), F.max("high").alias("b"))
                     .filter("n > 1 and a < b").select("leaf", "n"), "shared-leaves")
    shared, texts = stored(_shared_texts(docs, places, leaves, broadcast_rows), "shared-lines")
    general = _one_open(shared, lead, similarity).union(_majority(shared, merge_tokens, similarity))
    # A text may be of several templates; the earliest document keeps it.
    known = written(exact.union(general).groupBy("h1", "h2").agg(F.min("keep").alias("keep")), "recurring-lines")
    for path in (kept, texts):
        discard(docs.sparkSession, path)
    return known


def drop_recurring(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, lead: int = LEAD,
                   min_tokens: int = MIN_TOKENS, merge_tokens: int = MERGE_TOKENS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without recurring lines; with ``counts`` also ``n_lines`` and
    ``n_dropped``."""
    version = F.xxhash64(F.col(text_col))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc"), version.alias("version"), F.col(text_col).alias("text"))
    places = written(placed_lines(keyed, lead=lead, min_tokens=min_tokens), "placed-lines")
    known = recurring_templates(keyed, places, lead=lead, merge_tokens=merge_tokens, similarity=similarity)
    gone = (places.select("doc", "version", "pos", "h1", "h2").join(known, ["h1", "h2"]).filter(F.col("doc") != F.col("keep"))
            .groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_version")).agg(F.collect_set("pos").alias("_gone")))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    row = lambda c: F.col("_row")[c]
    joined = whole.join(gone, (row(id_col).cast("long") == F.col("_doc")) & (F.xxhash64(row(text_col)) == F.col("_version")), "left")
    split = F.split(row(text_col), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), row(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n"))
    out = [(text if c == text_col else row(c)).alias(c) for c in docs.columns]
    if counts:
        out += [F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"),
                F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped")]
    return joined.select(*out)
