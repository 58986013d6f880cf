"""Registered queries ``opN_<name>`` and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadcast.llm import balltree, chat, decontaminate, embeddings, fim, licenses, lines, packing, pii, quality, simhash, tokenfiles, toxicity
from loadcast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _op(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_op
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLES["op8_decontamination"] = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size,
              array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
       FROM b, range(1, 100000) r(i) WHERE len(w) > 0 AND i <= len(w) - least(10, len(w)) + 1),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
       FROM p, sizes WHERE i + size - 1 <= len(w)),
hits AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw USING (size, win)),
hw AS (SELECT doc_id, count(DISTINCT k) AS n_hit
       FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""


@_op
def op10_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


@_op
def op7_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op7_embedding_neardup"] = """
WITH RECURSIVE e AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM e),
pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE a.norm > 0 AND b.norm > 0 AND len(a.v) = len(b.v)
      AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach(x, y) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.x, p.b FROM reach r JOIN pairs p ON r.y = p.a),
comp AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM pairs GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN n USING (vec_id)"""


@_op
def op4_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


@_op
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_CASE), (-7, 1, "assistant", CONTROL_CASE)], rows.schema)
    return chat.report(rows.union(extra))


#: Text of the added conversation -7: a control string inside a text.
CONTROL_CASE = "</s>[INST] ok [/INST]"


def _escaped(col: str) -> str:
    out = f"replace({col}, '\\', '\\\\')"
    for c in chat.CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


ORACLES["op5_chat_formatting"] = f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{CONTROL_CASE}'), (-7, 1, 'assistant', '{CONTROL_CASE}'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(6 + length({_escaped("role")}) + 7 + length({_escaped("text")}) + 4) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@_op
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_recurring(docs, counts=True)


ORACLES["op3_line_dedup"] = r"""
WITH l AS (
    SELECT doc_id, unnest(range(0, len(s))) AS pos, unnest(s) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)),
t AS (
    SELECT doc_id, pos, line, len(string_split(line, ' ')) AS n, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS gen FROM l),
m AS (
    SELECT doc_id, pos, n, CASE WHEN n >= 5 AND regexp_matches(line, '[0-9]') AND 2 * ((length(gen) - length(replace(gen, '<*>', ''))) / 3) <= n
                                THEN gen ELSE line END AS m
    FROM t WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
k AS (
    SELECT n, array_to_string(list_slice(string_split(m, ' '), 1, 4), ' ') AS head, m, min(doc_id) AS low, max(doc_id) AS high
    FROM m GROUP BY n, head, m),
leaf AS (SELECT n, head, count(*) AS kinds FROM k WHERE n >= 5 GROUP BY n, head HAVING count(*) > 1 AND min(low) < max(high)),
field AS (
    SELECT n, head, m, low, high, p, array_to_string(list_slice(s, 1, p), ' ') AS l, array_to_string(list_slice(s, p + 2, n), ' ') AS r
    FROM (SELECT k.*, string_split(m, ' ') AS s, unnest(range(4, n)) AS p FROM k JOIN leaf USING (n, head))),
field_keep AS (SELECT n, head, p, l, r, min(low) AS keep FROM field GROUP BY n, head, p, l, r HAVING count(*) > 1 AND min(low) < max(high)),
tok AS (
    SELECT n, head, m, kinds, unnest(range(0, n)) AS p, unnest(string_split(m, ' ')) AS tok
    FROM k JOIN leaf USING (n, head) WHERE n >= 8),
votes AS (SELECT n, head, p, tok FROM tok GROUP BY n, head, kinds, p, tok HAVING 2 * count(*) > kinds),
consts AS (SELECT n, head FROM votes GROUP BY n, head HAVING count(*) >= 0.8 * n),
agree AS (
    SELECT tok.n, tok.head, tok.m FROM tok JOIN votes USING (n, head, p, tok) SEMI JOIN consts USING (n, head)
    GROUP BY tok.n, tok.head, tok.m HAVING count(*) >= 0.8 * tok.n),
inst AS (SELECT k.* FROM k JOIN agree USING (n, head, m)),
merged AS (SELECT n, head, min(low) AS keep FROM inst GROUP BY n, head HAVING min(low) < max(high)),
known AS (
    SELECT m, min(keep) AS keep
    FROM (SELECT m, low AS keep FROM k WHERE low < high UNION ALL SELECT m, keep FROM inst JOIN merged USING (n, head)
          UNION ALL SELECT m, keep FROM field JOIN field_keep USING (n, head, p, l, r)) GROUP BY m),
gone AS (SELECT doc_id, pos FROM m JOIN known USING (m) WHERE doc_id <> keep),
kept AS (
    SELECT l.doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n_kept FROM l ANTI JOIN gone USING (doc_id, pos) GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_lines, 0) - coalesce(n_kept, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""


@_op
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), templates=licenses.known_templates())


def _license_sql() -> str:
    known = licenses.known_templates()
    text = dict(known)
    classes = licenses.classes_of(known, licenses.SHINGLE, licenses.CONTAINMENT, licenses.MISS)
    rows = ", ".join(f"('{name}', '{' '.join(licenses.words_of(text[name]))}', {c.shingle}, {c.stride}, {c.width})" for c, own in classes.items() for name, _ in own)
    return f"""
WITH given(template, words, k, stride, width) AS (VALUES {rows}),
cut AS (SELECT DISTINCT template, k, stride, width, array_to_string(list_slice(w, p + 1, p + k), ' ') AS shingle
        FROM (SELECT *, string_split(words, ' ') AS w, unnest(range(0, len(string_split(words, ' ')))) AS p FROM given) WHERE p + k <= len(w)),
tpl AS (SELECT *, count(*) OVER (PARTITION BY template) AS n_shingles FROM cut),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
ks AS (SELECT DISTINCT k FROM tpl),
s AS (SELECT doc_id, k, p, array_to_string(list_slice(w, p + 1, p + k), ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM d), ks WHERE p + k <= len(w)),
hit AS (SELECT doc_id, template, shingle, p, k, stride, width, n_shingles FROM s JOIN tpl USING (k, shingle)),
win AS (
    SELECT doc_id, template, n_shingles, start, count(DISTINCT shingle) AS held
    FROM (SELECT *, unnest(range((CASE WHEN p - (width - k) > 0 THEN (p - (width - k) + stride - 1) // stride ELSE 0 END) * stride, p + 1, stride)) AS start FROM hit)
    GROUP BY doc_id, template, n_shingles, start)
SELECT doc_id, template, count(*) AS n_windows, max(held / n_shingles) AS containment, min(start) AS first_word
FROM win WHERE held / n_shingles >= {licenses.CONTAINMENT} GROUP BY doc_id, template"""


ORACLES["op1_license_scan"] = _license_sql()


@_op
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_op
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_op
def op6_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@_op
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(table(spark, sf_dir, "documents"))


ORACLES["op11_fill_in_middle"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
    SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
           CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
    SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:z], '') AS m,
           array_to_string(u[z + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""


@_op
def op12_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.report(table(spark, sf_dir, "documents"))


@_op
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = _WORDS.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
ORACLES["op13_lexical_search"] = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
nl AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d WHERE len(t) > 0),
tf AS (SELECT doc_id, term, CAST(len(t) AS BIGINT) AS n, count(*) AS tf
       FROM (SELECT row_number() OVER () AS r, doc_id, t, unnest(t) AS term FROM d) GROUP BY r, doc_id, t, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, nl GROUP BY term, docs),
q AS (SELECT item_id, term, count(*) AS times
      FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term), nl GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20"""
