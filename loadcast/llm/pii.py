"""Personal data: base patterns, and bootstrapped contextual extraction, in
DataFrame operations only.

Base kinds (leftmost, non-overlapping per kind; failing matches are dropped
without retries): e-mail addresses, dotted IPv4 numbers, card numbers passing
Luhn, international telephone numbers.  The regular expressions are the stated
ones made linear: possessive where nothing can follow, and started only where a
run of their first class starts (or where the last match ended).

Base matches are the seeds of the bootstrap, whatever their characters.
Identifier-like tokens (white space free, with a digit, ``@``, ``_`` or a symbol
between letters) are instances; the word before, the two words before and the
word after are lexical patterns, digits blurred.  Each round scores the
pattern-instance graph: a pattern by the mean confidence of the distinct
instances it extracts (at least ``MIN_SEEDS`` of them trusted), an instance by a
noisy-or over its patterns; seeds stay 1.  After ``ROUNDS`` rounds every
occurrence of an unseen identifier (``MIN_LENGTH`` characters; two digits or such
a symbol) whose score reaches ``CONFIDENCE`` is a span of kind ``id``.  The graph
is aggregated before every join, so a pattern that occurs everywhere is one row
a task.

Defined results: null and empty texts have no spans; repeated rows have equal
results; ties need no order (scores are means and products); an empty table
gives an empty result; extra columns are not read.  Offsets are code points,
end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import written

ROUNDS = 3
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.6   # of a pattern, to extract at all
CONFIDENCE = 0.9       # of an unseen identifier, for its occurrences to be spans
MIN_LENGTH = 6         # of an unseen identifier
KINDS = ["email", "ip", "card", "phone", "id"]

_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_SIGN = r"[0-9@_]|(?<=[A-Za-z])[()\[\]{}:/\\#~+=&*.](?=[A-Za-z])"
TOKEN = rf"(?<!\S)(?:(?!{_SIGN})\S)*+(?:{_SIGN})\S*+"
_BYTE = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPAN = "array<struct<s:bigint,e:bigint,m:string,g:string>>"
_CHUNK = 200


def matches(text: Column, pattern: str, possible: Column) -> Column:
    """``array<struct<s, e, m, g>>`` of all matches, if ``possible``; ``g`` is
    the text since the match before.  Built in chunks, so that a text with very
    many matches takes time in proportion."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.expr(f"cast(array() as {_SPAN})")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(x["g"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(
            s.alias("s"), e.alias("e"), x["m"].alias("m"), x["g"].alias("g")))).alias("out"))

    def chunk(acc: Column, pairs: Column) -> Column:
        own = F.aggregate(pairs, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return F.struct(own["at"].alias("at"), F.concat(acc["out"], own["out"]).alias("out"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def located(known: Column) -> Column:  # a variable, so that the matches are made once
        chunks = F.transform(F.sequence(F.lit(0), F.floor(F.size(known) / _CHUNK).cast("int")),
                             lambda c: F.slice(known, c * _CHUNK + 1, F.lit(_CHUNK)))
        return F.aggregate(chunks, first, chunk, lambda acc: acc["out"])
    return F.when(possible & text.rlike(pattern), F.get(F.transform(F.array(pairs), located), F.lit(0))).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right, the last but one first, is doubled."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid_card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False)


def base_spans(text: Column, has_digit: Column) -> dict[str, Column]:
    return {
        "email": matches(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(matches(text, IP, has_digit), lambda x: x["m"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        "card": F.filter(matches(text, CARD, has_digit), lambda x: _valid_card(x["m"])),
        "phone": F.filter(matches(text, PHONE, F.contains(text, F.lit("+"))), lambda x: F.length(_digits(x["m"])).between(8, 15)),
    }


def _blur(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), "[0-9]", "9")


def _words(text: Column) -> Column:
    """White-space separated words of a short text."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def candidates(tokens: Column) -> Column:
    """Matches of ``TOKEN`` -> ``array<struct<s, e, core, patterns>>``; ``core``
    has no outer punctuation, patterns are hashes."""
    def one(x: Column, i: Column) -> Column:
        core = F.ltrim(x["m"], F.lit("\"'(["))
        s = x["s"] + F.length(x["m"]) - F.length(core)
        core = F.rtrim(core, F.lit("\"')].,;:!?"))
        before, after = F.get(tokens, i - 1), F.get(tokens, i + 1)

        def patterns(near: Column) -> Column:
            left, right = near["left"], near["right"]
            one_left, two_left = F.get(left, F.size(left) - 1), F.get(left, F.size(left) - 2)
            named = F.array(F.concat(F.lit("L "), _blur(one_left)), F.concat(F.lit("LL "), _blur(two_left), F.lit(" "), _blur(one_left)),
                            F.concat(F.lit("R "), _blur(F.get(right, F.lit(0)))))
            return F.transform(F.filter(named, lambda p: p.isNotNull()), lambda p: F.xxhash64(p))
        # A variable, so that the gaps are split once.
        near = F.array(F.struct(_words(F.concat_ws(" ", before["m"], x["g"])).alias("left"),
                                _words(F.concat_ws(" ", after["g"], after["m"])).alias("right")))
        return F.struct(s.alias("s"), (s + F.length(core)).alias("e"), core.alias("core"),
                        F.get(F.transform(near, patterns), F.lit(0)).alias("patterns"))
    return F.transform(tokens, one)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
         min_confidence: float = MIN_CONFIDENCE, confidence: float = CONFIDENCE) -> DataFrame:
    """``(doc_id, base, spans)``: sorted ``array<struct<k, s, e>>``, ``k`` the
    place of the kind in ``KINDS``; ``spans`` has the base ones and the found."""
    text = F.coalesce(F.col("t"), F.lit(""))
    has_digit = text.rlike("[0-9]")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("version"), F.col(text_col).cast("string").alias("t"))
    kinds = base_spans(text, has_digit)
    base = F.array_sort(F.concat(*[_kind(c, KINDS.index(name)) for name, c in kinds.items()]))
    # A last, empty match carries what follows the last token.
    rest = F.struct(F.lit(None).cast("long").alias("s"), F.lit(None).cast("long").alias("e"), F.lit(None).cast("string").alias("m"),
                    F.element_at(F.split(text, TOKEN, -1), -1).alias("g"))
    tokens = matches(text, TOKEN, F.lit(True))
    rows = rows.select("doc_id", "version", base.alias("base"), F.when(F.size(tokens) > 0, F.concat(tokens, F.array(rest))).otherwise(tokens).alias("tokens"))
    cand = F.filter(candidates(F.col("tokens")), lambda c: c["s"].isNotNull())
    found = written(rows.select("doc_id", "version", "base", cand.alias("cand")), "pii")
    seed = F.exists("base", lambda b: (b["s"] < F.col("c.e")) & (b["e"] > F.col("c.s")))
    seen = written(found.select("doc_id", "version", "base", F.explode("cand").alias("c"))
                   .select("doc_id", "version", "c.s", "c.e", F.xxhash64("c.core").alias("instance"), seed.alias("seed"),
                           (~seed & F.col("c.core").rlike(rf"[0-9].*[0-9]|(?![0-9])(?:{_SIGN})") & (F.length("c.core") >= MIN_LENGTH)).alias("unseen"),
                           F.col("c.patterns").alias("patterns")), "pii-instances")
    edges = written(seen.select(F.explode("patterns").alias("pattern"), "instance", "seed").groupBy("pattern", "instance")
                    .agg(F.max("seed").alias("seed")), "pii-graph")
    scores = seen.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    trusted = None
    for _ in range(rounds):
        pattern = (edges.join(scores, "instance").groupBy("pattern")
                   .agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("conf"), F.sum((F.col("score") >= 0.5).cast("int")).alias("support"))
                   .filter((F.col("support") >= min_seeds) & (F.col("conf") >= min_confidence)).select("pattern", "conf"))
        trusted = written(pattern, "pii-patterns")
        doubt = F.exp(F.sum(F.log1p(-F.least(F.coalesce("conf", F.lit(0.0)), F.lit(0.999)))))
        scores = written(edges.join(trusted, "pattern", "left").groupBy("instance")
                         .agg(F.when(F.max("seed"), 1.0).otherwise(1 - doubt).alias("score")), "pii-scores")
    known = scores.filter(F.col("score") >= confidence).select("instance")
    more = (seen.filter("unseen").join(known, "instance", "left_semi").groupBy(F.col("doc_id").alias("d"), F.col("version").alias("v"))
            .agg(F.collect_set(F.struct(F.lit(KINDS.index("id")).alias("k"), "s", "e")).alias("more")))
    both = found.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("version").eqNullSafe(F.col("v")), "left")
    return both.select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("more", F.expr("cast(array() as array<struct<k:int,s:bigint,e:bigint>>)")))).alias("spans"))


def _kind(spans: Column, k: int) -> Column:
    return F.transform(spans, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    out = scan(docs)
    counts = [F.size(_of_kind("base", k)).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _of_kind(col: str, k: int) -> Column:
    return F.filter(col, lambda x: x["k"] == k)
