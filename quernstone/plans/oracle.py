"""The same results in plain SQL, for the comparison with another engine."""

from __future__ import annotations

from quernstone.operators import evaluation, judging, prompting
from quernstone.operators.answering import UNKNOWN
from quernstone.plans import catalog

# The patterns as the survey states them, spelled out here so that a wrong pattern of
# the implementation is not wrong on both sides.
NON_WORD = r"[^\p{L}\p{N}]+"
SENTENCE_END = r"([.!?])[ \t\r]+"
VOWEL_GROUP = "[aeiouyáàâäãåéèêëíìîïóòôöõøúùûüýÿœæ]+"
BLANKS = r"[ \t\r\n\f]+"
ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
DROPPED_MARKUP = [
    r"(?is)<!--.*?-->",
    r"(?is)<script\b.*?</script[^>]*>",
    r"(?is)<style\b.*?</style[^>]*>",
    r"(?is)<head\b.*?</head[^>]*>",
    r"(?s)<[^>]*>",
]


def _lit(text: str) -> str:
    """A SQL string; line ends are put in by ``chr`` so that the query stays on plain lines."""
    lines = ["'" + line.replace("'", "''") + "'" for line in text.split("\n")]
    return "(" + " || chr(10) || ".join(lines) + ")"


def _tok(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '{NON_WORD}'), lambda t: t <> '')"


def _sentences(x: str) -> str:
    blanks = "' ' || chr(9) || chr(13)"
    marked = f"regexp_replace({x}, '{SENTENCE_END}', '\\1' || chr(10), 'g')"
    return (
        f"list_filter(list_transform(string_split_regex({marked}, '\\n+'), "
        f"lambda s: trim(s, {blanks})), lambda s: s <> '')"
    )


def _grams(x: str, n: int) -> str:
    if n == 1:
        return x
    return (
        f"list_transform(range(1, len({x}) - {n - 2}), "
        f"lambda i: array_to_string({x}[i:i + {n - 1}], ' '))"
    )


def _letters(x: str) -> str:
    return f"length(regexp_replace({x}, '{NON_WORD}', '', 'g'))"


PAIRS = """
turns AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (
  SELECT conv_id * 1000000 + turn AS qid, text AS questions, next_text AS ground_truth
  FROM turns WHERE role = 'user' AND next_role = 'assistant')"""

CHUNKS = """
starts AS (
  SELECT doc_id, text,
         unnest(range(0, greatest(0, CAST(ceil((length(text) - 512) / 480.0) AS BIGINT)) + 1)) AS i
  FROM documents),
chunks AS (
  SELECT doc_id * 1000000 + i AS id, doc_id, substr(text, i * 480 + 1, 512) AS page_content
  FROM starts)"""

BM25 = f"""
words AS MATERIALIZED (SELECT id, {_tok('page_content')} AS t FROM chunks),
size AS (SELECT count(*) AS n, avg(len(t)) AS mean_len FROM words),
tf AS (SELECT id, w, count(*) AS tf FROM (SELECT id, unnest(t) AS w FROM words) GROUP BY ALL),
terms AS MATERIALIZED (
  SELECT w, df, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf
  FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), size),
asked AS MATERIALIZED (
  SELECT qid, unnest(list_distinct({_tok('questions')})) AS w FROM pairs),
scores AS (
  SELECT qid, id,
         round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean_len))), 6) AS score
  FROM asked JOIN terms USING (w) JOIN tf USING (w) JOIN words USING (id), size
  GROUP BY qid, id)"""


def _hits(k: int) -> str:
    return f"""
hits AS MATERIALIZED (
  SELECT qid, rank, id, page_content, score FROM (
    SELECT qid, id, score,
           row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank
    FROM scores) JOIN chunks USING (id) WHERE rank <= {k})"""


def _prompt_expr() -> str:
    before, rest = prompting.TEMPLATE.split("{context}")
    middle, after = rest.split("{question}")
    return (
        f"{_lit(before)} || coalesce(context, '') || {_lit(middle)} || questions || {_lit(after)}"
    )


CONTEXTS = f"""
contexts AS (
  SELECT qid, string_agg(page_content, chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits GROUP BY qid),
prompts AS (
  SELECT qid, questions, ground_truth, coalesce(context, '') AS context,
         {_prompt_expr()} AS prompt
  FROM pairs LEFT JOIN contexts USING (qid))"""

ANSWERS = f"""
lines AS (SELECT qid, rank, {_sentences('page_content')} AS l FROM hits),
sents AS MATERIALIZED (
  SELECT qid, rank, i, l[i] AS s, list_distinct({_tok('l[i]')}) AS st
  FROM (SELECT qid, rank, l, unnest(range(1, len(l) + 1)) AS i FROM lines)),
found AS (
  SELECT qid, rank, i, s, round(sum(idf) / sqrt(any_value(n)), 6) AS score
  FROM (SELECT qid, rank, i, s, len(st) AS n, unnest(st) AS w FROM sents)
  JOIN asked USING (qid, w) JOIN terms USING (w)
  GROUP BY qid, rank, i, s),
best AS (
  SELECT qid, s FROM found
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, rank, i) = 1),
answers AS MATERIALIZED (
  SELECT qid, questions, ground_truth, coalesce(s, '{UNKNOWN}') AS result, s IS NULL AS abstained
  FROM pairs LEFT JOIN best USING (qid))"""


def _flow(k: int = catalog.K) -> str:
    return "WITH" + ",".join([PAIRS, CHUNKS, BM25, _hits(k), ANSWERS])


def _overlap(n: int, answers: str = "answers") -> str:
    """A table ``over<n>``: qid, a, b, shared. The texts of a row are exploded to their n-grams."""
    grams = ", ".join(
        f"{_grams(f'{side}_t', n)} AS {side}_g" for side in ("said", "wanted")
    )
    return f"""
split{n} AS (
  SELECT qid, {_tok('result')} AS said_t, {_tok('ground_truth')} AS wanted_t FROM {answers}),
grams{n} AS (SELECT qid, {grams} FROM split{n}),
bags{n} AS (
  SELECT qid, g, sum(said) AS said, sum(wanted) AS wanted FROM (
    SELECT qid, unnest(said_g) AS g, 1 AS said, 0 AS wanted FROM grams{n}
    UNION ALL SELECT qid, unnest(wanted_g), 0, 1 FROM grams{n})
  GROUP BY qid, g),
sums{n} AS (
  SELECT qid, sum(said) AS a, sum(wanted) AS b, sum(least(said, wanted)) AS shared
  FROM bags{n} GROUP BY qid),
over{n} AS (
  SELECT qid, round(shared / a, 6) AS p, round(shared / b, 6) AS r, round(2 * shared / (a + b), 6) AS f
  FROM {answers} LEFT JOIN (SELECT * FROM sums{n} WHERE a > 0 AND b > 0) USING (qid))"""


def _readability(x: str) -> str:
    counts = {
        "n_words": f"len({_tok(x)})",
        "n_sentences": f"len(list_filter({_sentences(x)}, lambda s: {_letters('s')} > 0))",
        "n_syllables": f"len(regexp_extract_all(lower({x}), '{VOWEL_GROUP}'))",
        "n_letters": _letters(x),
    }
    return ", ".join(f"CAST({value} AS INTEGER) AS {name}" for name, value in counts.items())


_GRADES = """
  CASE WHEN n_words > 0 AND n_sentences > 0 THEN
    round(0.39::DOUBLE * n_words / n_sentences + 11.8::DOUBLE * n_syllables / n_words - 15.59, 6)
  END AS flesch_kincaid_grade,
  CASE WHEN n_words > 0 AND n_sentences > 0 THEN
    round(4.71::DOUBLE * n_letters / n_words + 0.5::DOUBLE * n_words / n_sentences - 21.43, 6)
  END AS ari_grade"""


def _values(run_id: str, suffix: str = "", answers: str = "answers", hits: str = "hits") -> str:
    """A table ``vals``: run_id, qid, metric, value."""
    union = " UNION ALL ".join(
        f"SELECT '{run_id}' AS run_id, qid, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM scored{suffix}"
        for m in (*catalog.SUMMARY_METRICS, "toxicity")
    )
    return f"""
reads{suffix} AS (SELECT qid, {_readability('result')} FROM {answers}),
grades{suffix} AS (SELECT qid, {_GRADES} FROM reads{suffix}),
tox_words{suffix} AS (SELECT qid, unnest({_tok('result')}) AS t FROM {answers}),
toxic{suffix} AS (
  SELECT a.qid, round(1 / (1 + exp(-(odds + prior))), 6) AS toxicity
  FROM {answers} a LEFT JOIN (
    SELECT qid, sum(coalesce(ln(a + 1) - ln(b + 1), 0) + unseen) AS odds
    FROM tox_words{suffix} LEFT JOIN tox_counted USING (t), tox_sums GROUP BY qid) o USING (qid), tox_prior),
{_rouge_l_parts(suffix, answers)},{_faithfulness_parts('result', 3, suffix, answers, hits)},
{_relevance_parts(suffix, answers, hits)},
scored{suffix} AS MATERIALIZED (
  SELECT qid, CASE WHEN len({_tok('result')}) > 0 AND len({_tok('ground_truth')}) > 0
              THEN CAST({_tok('result')} = {_tok('ground_truth')} AS INTEGER) END AS exact_match,
         o1.f AS token_f1, o1.f AS rouge1_f1, o2.f AS rouge2_f1, flesch_kincaid_grade, ari_grade,
         rouge_l, faithfulness_lexical, relevance_lexical, toxicity
  FROM {answers} JOIN over1{suffix} o1 USING (qid) JOIN over2{suffix} o2 USING (qid)
  JOIN grades{suffix} USING (qid) JOIN longest{suffix} USING (qid) JOIN faithful{suffix} USING (qid)
  JOIN relevant{suffix} USING (qid) JOIN toxic{suffix} USING (qid)),
vals{suffix} AS (SELECT * FROM ({union}))"""


def _overlap_for(n: int, suffix: str, answers: str) -> str:
    text = _overlap(n, answers)
    for name in ("split", "grams", "bags", "sums", "over"):
        text = text.replace(f"{name}{n}", f"{name}{n}{suffix}")
    return text


def _two_runs() -> str:
    """``vals``: the values of the runs with one and with four chunks per question."""
    parts = [PAIRS, CHUNKS, BM25, _TOXIC_MODEL]
    for k, suffix in ((1, "_a"), (catalog.K, "_b")):
        for text in (_hits(k), ANSWERS):
            for name in ("hits", "lines", "sents", "found", "best", "answers"):
                text = text.replace(f"{name} AS", f"{name}{suffix} AS").replace(
                    f"FROM {name}", f"FROM {name}{suffix}"
                ).replace(f"JOIN {name}", f"JOIN {name}{suffix}")
            parts.append(text)
        parts += [_overlap_for(n, suffix, f"answers{suffix}") for n in (1, 2)]
        parts.append(_values(f"top{k}", suffix, f"answers{suffix}", f"hits{suffix}"))
    parts.append("\nvals AS (SELECT * FROM vals_a UNION ALL SELECT * FROM vals_b)")
    return "WITH RECURSIVE" + ",".join(parts)


def _vectors(asked: str = "SELECT CAST(NULL AS BIGINT) AS qid, '' AS text") -> str:
    """``vectors``: id or qid, d, w: token weights by dimension, scaled to unit length."""
    dims = catalog.DIMENSIONS
    bucket = f"CAST('0x' || substr(md5(t), 1, 7) AS BIGINT) % {dims}"
    return f"""WITH {PAIRS}, {CHUNKS},
texts AS (
  SELECT id, CAST(NULL AS BIGINT) AS qid, {_tok('page_content')} AS tokens FROM chunks
  UNION ALL SELECT NULL, qid, {_tok('text')} FROM ({asked})),
parts AS MATERIALIZED (
  SELECT id, qid, d, count(*) AS n
  FROM (SELECT id, qid, {bucket} AS d FROM (SELECT id, qid, unnest(tokens) AS t FROM texts))
  GROUP BY ALL),
idf AS (
  SELECT d, ln(((SELECT count(*) FROM chunks) + 1) / (coalesce(df, 0) + 1)::DOUBLE) AS idf
  FROM range({dims}) r(d) LEFT JOIN (SELECT d, count(*) AS df FROM parts WHERE id IS NOT NULL GROUP BY d) USING (d)),
vectors AS MATERIALIZED (
  SELECT id, qid, d, CAST(n * idf / sqrt(sum((n * idf) ** 2) OVER (PARTITION BY id, qid)) AS FLOAT) AS w
  FROM parts JOIN idf USING (d) WHERE idf <> 0)"""


def _nearest(asked: str, k: int, score: bool = True) -> str:
    """Brute force over all questions and chunks; a pair without a common dimension scores 0."""
    return f"""{_vectors(asked)},
norms AS (SELECT id, qid, sqrt(sum(CAST(w AS DOUBLE) ** 2)) AS norm FROM vectors GROUP BY id, qid),
met AS (
  SELECT q.qid, c.id, sum(CAST(q.w AS DOUBLE) * c.w) AS dot
  FROM vectors q JOIN vectors c ON q.d = c.d AND q.qid IS NOT NULL AND c.id IS NOT NULL GROUP BY q.qid, c.id),
cosines AS (
  SELECT q.qid, c.id, c.page_content, round(coalesce(dot / nq.norm / nc.norm, 0), 6) AS score
  FROM ({asked}) q CROSS JOIN chunks c LEFT JOIN met ON met.qid = q.qid AND met.id = c.id
  LEFT JOIN norms nq ON nq.qid = q.qid LEFT JOIN norms nc ON nc.id = c.id)
SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank,
  id, page_content{", score" if score else ""}
FROM cosines QUALIFY rank <= {k}"""


_TOXIC_MODEL = f"""
tox_docs AS MATERIALIZED (
  SELECT doc_id, unnest({_tok('text')}) AS t FROM documents),
tox_learned AS (
  SELECT doc_id, toxic FROM labels
  WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 30),
tox_counted AS MATERIALIZED (
  SELECT t, count(*) FILTER (WHERE toxic = 1) AS a, count(*) FILTER (WHERE toxic = 0) AS b
  FROM tox_docs JOIN tox_learned USING (doc_id) GROUP BY t),
tox_sums AS (SELECT ln((sum(b) + count(*) + 1) / (sum(a) + count(*) + 1)::DOUBLE) AS unseen FROM tox_counted),
tox_prior AS (
  SELECT ln((count(*) FILTER (WHERE toxic = 1) + 1) / (count(*) FILTER (WHERE toxic = 0) + 1)::DOUBLE) AS prior
  FROM tox_learned JOIN documents USING (doc_id))"""

_TOXICITY = f"""WITH {_TOXIC_MODEL},
odds AS (
  SELECT doc_id, sum(coalesce(ln(a + 1) - ln(b + 1), 0) + unseen) AS odds
  FROM tox_docs LEFT JOIN tox_counted USING (t), tox_sums GROUP BY doc_id),
scored AS (
  SELECT doc_id, round(1 / (1 + exp(-(odds + prior))), 6) AS toxicity
  FROM documents LEFT JOIN odds USING (doc_id), tox_prior),
flagged AS (SELECT doc_id, toxicity, toxicity >= 0.5 AS toxic_flag FROM scored)"""


def _page_text() -> str:
    def decoded(x: str) -> str:
        for entity, char in ENTITIES:
            new = "''''" if char == "'" else f"'{char}'"
            x = f"replace({x}, '{entity}', {new})"
        return x

    def squeezed(x: str) -> str:
        return f"trim(regexp_replace({x}, '{BLANKS}', ' ', 'g'))"

    text = "html"
    for pattern in DROPPED_MARKUP:
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    title = squeezed(decoded("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)"))
    return f"""SELECT page_id, url, {title} AS title, {squeezed(decoded(text))} AS text,
      url AS meta_source,
      lower(regexp_extract(html, '(?is)<html[^>]*\\blang="([^"]*)"', 1)) AS meta_language
    FROM pages"""


def _chunk_merge(split_long: bool) -> str:
    """Piece by piece over all documents at once; ``held`` is what the open chunk holds."""
    sep, size, overlap = "chr(10)", 512, 32
    joined = f"array_to_string(held, {sep})"
    fits = f"(len(held) = 0 OR length({joined}) + 1 + length(p) <= {size})"

    def tail(start: str) -> str:
        return f"array_to_string(held[{start}:], {sep})"

    keep = (
        f"held[list_min(list_filter(range(1, len(held) + 2), lambda s: s = len(held) + 1 OR "
        f"(length({tail('s')}) <= {overlap} AND length({tail('s')}) + 1 + length(p) <= {size}))):]"
    )
    long = f"length(p) > {size}" if split_long else "false"
    blanks = "' ' || chr(9) || chr(10) || chr(13)"
    empty = "CAST([] AS VARCHAR[])"
    cuts = (
        "list_transform(range(0, greatest(0, CAST(ceil((length(p) - 512) / 480.0) AS BIGINT)) + 1), "
        "lambda i: substr(p, i * 480 + 1, 512))"
    )
    return f"""WITH RECURSIVE pieces AS (
      SELECT doc_id, list_filter(string_split(text, {sep}), lambda x: x <> '') AS ps
      FROM documents),
    walk AS (
      SELECT doc_id, CAST(0 AS BIGINT) AS pos, {empty} AS held, {empty} AS done FROM pieces
      UNION ALL
      SELECT doc_id, pos + 1,
        CASE WHEN p IS NULL OR {long} THEN {empty} WHEN {fits} THEN list_append(held, p)
             ELSE list_append({keep}, p) END,
        CASE WHEN p IS NULL THEN [trim({joined}, {blanks})]
             WHEN {long} THEN list_concat([trim({joined}, {blanks})], {cuts})
             WHEN {fits} THEN {empty} ELSE [trim({joined}, {blanks})] END
      FROM (SELECT w.*, ps, ps[pos + 1] AS p FROM walk w JOIN pieces USING (doc_id)
            WHERE pos <= len(ps))),
    out AS (
      SELECT doc_id, pos, i, done[i] AS page_content
      FROM (SELECT doc_id, pos, done, unnest(range(1, len(done) + 1)) AS i FROM walk)
      WHERE done[i] <> ''),
    numbered AS (
      SELECT doc_id, page_content,
             row_number() OVER (PARTITION BY doc_id ORDER BY pos, i) - 1 AS chunk_no FROM out)
    SELECT doc_id * 1000000 + chunk_no AS id, doc_id, CAST(chunk_no AS INTEGER) AS chunk_no,
           page_content FROM numbered"""


def _knn(items: str = "embeddings") -> str:
    return f"""WITH v AS MATERIALIZED (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
             sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
      FROM embeddings),
    w AS MATERIALIZED (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
             sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
      FROM {items}),
    s AS (
      SELECT a.vec_id AS qid, b.vec_id AS id,
             round(list_dot_product(a.e, b.e) / (a.norm * b.norm), 6) AS score
      FROM v a, w b)
    SELECT qid, rank, id, score FROM (
      SELECT qid, id, score,
             CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank
      FROM s) WHERE rank <= {catalog.K}"""


_ARRIVED = """final AS (
  SELECT doc_id, CASE WHEN lang = 'fr' THEN replace(text, chr(10), ' ') ELSE text END AS text
  FROM documents WHERE source IS DISTINCT FROM 'src0')"""


def _rouge_l_parts(suffix: str = "", answers: str = "answers") -> str:
    """``longest``: qid, rouge_l. One row of the LCS table per step: a running maximum over the
    positions of the target."""
    x = suffix
    return f"""
    texts{x} AS MATERIALIZED (
      SELECT qid, {_tok('result')} AS a, {_tok('ground_truth')} AS b FROM {answers}),
    cells{x} AS (
      SELECT qid, a, len(a) AS n, j, b[j] AS y FROM (
        SELECT qid, a, b, unnest(range(1, len(b) + 1)) AS j FROM texts{x})),
    lcs{x} AS (
      SELECT qid, CAST(0 AS BIGINT) AS i, j, 0 AS v FROM cells{x}
      UNION ALL
      SELECT qid, i + 1, j,
             max(greatest(v, CASE WHEN y = x THEN diag + 1 ELSE 0 END))
               OVER (PARTITION BY qid ORDER BY j ROWS UNBOUNDED PRECEDING)
      FROM (
        SELECT l.qid, i, l.j, v, y, a[i + 1] AS x,
               coalesce(lag(v) OVER (PARTITION BY l.qid ORDER BY l.j), 0) AS diag
        FROM lcs{x} l JOIN cells{x} c ON l.qid = c.qid AND l.j = c.j WHERE i < n)),
    longest{x} AS (
      SELECT qid, CASE WHEN len(a) > 0 AND len(b) > 0
                  THEN round(2.0::DOUBLE * v / (len(a) + len(b)), 6) END AS rouge_l
      FROM texts{x} LEFT JOIN (SELECT qid, i, max(v) AS v FROM lcs{x} GROUP BY qid, i) m
        USING (qid) WHERE i = len(a) OR i IS NULL)"""


def _rouge_l() -> str:
    return f"{_flow().replace('WITH', 'WITH RECURSIVE', 1)},{_rouge_l_parts()} SELECT * FROM longest"


def _faithfulness_parts(answer: str, n: int, suffix: str = "", answers: str = "answers", hits: str = "hits") -> str:
    def share(size: int) -> str:
        mine = f"list_distinct({_grams('t', size)})"
        return f"len(list_intersect({mine}, g{size})) / len({mine})"

    x = suffix
    return f"""
    given{x} AS (
      SELECT qid, flatten(list({_grams('t', n)})) AS g{n}, flatten(list(t)) AS g1
      FROM (SELECT qid, {_tok('page_content')} AS t FROM {hits}) GROUP BY qid),
    said{x} AS (
      SELECT qid, abstained, {_tok(answer)} AS t FROM {answers}),
    faithful{x} AS (
    SELECT qid, CASE WHEN abstained OR len(t) = 0 THEN NULL
      WHEN len(t) >= {n} THEN CAST(1 + floor(round(4 * ({share(n)}), 6)) AS INTEGER)
      ELSE CAST(1 + floor(round(4 * ({share(1)}), 6)) AS INTEGER) END AS faithfulness_lexical
    FROM said{x} LEFT JOIN given{x} USING (qid))"""


def _faithfulness(answer: str, n: int) -> str:
    return f"{_flow()},{_faithfulness_parts(answer, n)} SELECT * FROM faithful"


def _relevance_parts(suffix: str = "", answers: str = "answers", hits: str = "hits") -> str:
    x = suffix
    return f"""
    seen{x} AS (
      SELECT qid, unnest({_tok('page_content')}) AS w FROM {hits}
      UNION SELECT qid, unnest({_tok('result')}) FROM {answers}),
    weights{x} AS (
      SELECT qid, w, coalesce(idf, ln(1 + (n + 0.5) / 0.5)) AS idf
      FROM asked LEFT JOIN terms USING (w), size),
    shares{x} AS (
      SELECT qid, sum(CASE WHEN s.w IS NOT NULL THEN idf ELSE 0 END) / sum(idf) AS share
      FROM weights{x} LEFT JOIN seen{x} s USING (qid, w) GROUP BY qid),
    relevant{x} AS (
      SELECT qid, CAST(1 + floor(round(4 * share, 6)) AS INTEGER) AS relevance_lexical
      FROM pairs LEFT JOIN shares{x} USING (qid))"""


_RELEVANCE = f"{_flow()},{_relevance_parts()} SELECT * FROM relevant"


def _judge_prompt() -> str:
    low, high = judging.GRADES
    head = (
        f"{judging.RULES['faithfulness']} Scores run from {low} (worst) to {high} (best).\n"
        'Reply with JSON: {"score": <integer>, "justification": "<text>"}.\n\n'
        f"{judging.render_examples(judging.EXAMPLES)}\n\nInput: "
    )
    return f"""{_flow()},{CONTEXTS}
    SELECT qid, {_lit(head)} || questions || {_lit(chr(10) + 'Output: ')} || result
           || {_lit(chr(10) + 'context: ')} || context AS judge_prompt
    FROM answers JOIN (SELECT qid, context FROM prompts) USING (qid)"""


_METRICS = """
stats AS (
  SELECT run_id, metric, avg(value) AS mean, var_pop(value) AS variance,
         quantile_cont(value, 0.9) AS p90, CAST(count(value) AS DOUBLE) AS count
  FROM vals GROUP BY run_id, metric)"""


def _chat_render() -> str:
    return """SELECT conv_id, CAST(0 AS BIGINT) AS part, count(*) AS n_turns,
      string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn)
        || '<|assistant|>' || chr(10) AS rendered
    FROM conversations GROUP BY conv_id"""


def _route_share() -> str:
    bucket = "CAST('0x' || substr(md5(CAST(qid AS VARCHAR)), 1, 8) AS BIGINT) % 100"
    cases, low = [], 0
    for name, pct in catalog.ROUTES.items():
        cases.append(f"WHEN bucket < {low + pct} THEN '{name}'")
        low += pct
    return f"""WITH {PAIRS}, b AS (SELECT {bucket} AS bucket FROM pairs)
    SELECT CASE {' '.join(cases)} END AS model, count(*) AS questions,
           CAST(sum(bucket) AS BIGINT) AS bucket_sum
    FROM b GROUP BY ALL"""


def _route_stable() -> str:
    names = {**catalog.ROUTES, **catalog.ROUTES_LATER}
    rows = ", ".join(f"('{n}', {catalog.ROUTES.get(n, 0)}, {catalog.ROUTES_LATER.get(n, 0)})" for n in names)
    hashed = "CAST('0x' || substr(md5(CAST(qid AS VARCHAR) || '|' || name), 1, 8) AS BIGINT)"

    def best(weight: str) -> str:
        return f"arg_max(name, ln(({hashed} + 0.5::DOUBLE) / 4294967296::DOUBLE) / {weight}) FILTER (WHERE {weight} > 0)"

    return f"""WITH {PAIRS}, r(name, w1, w2) AS (VALUES {rows}),
    chosen AS (SELECT qid, {best("w1")} AS before, {best("w2")} AS after FROM pairs, r GROUP BY qid)
    SELECT before, after, count(*) AS questions FROM chosen GROUP BY ALL"""


_CHAT_REQUESTS = f"""WITH {PAIRS},
    first AS (SELECT conv_id, arg_min(text, turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
    talk AS (
      SELECT conv_id * 1000000 + turn AS qid, conv_id,
             coalesce(list(role || ': ' || text) OVER (PARTITION BY conv_id ORDER BY turn
               ROWS BETWEEN {catalog.HISTORY} PRECEDING AND 1 PRECEDING), []) AS history
      FROM conversations WHERE role IS DISTINCT FROM 'system'),
    whole AS (
      SELECT qid, CASE WHEN system IS NULL THEN [] ELSE ['system: ' || system] END || history || ['user: ' || questions] AS m
      FROM pairs JOIN talk USING (qid) LEFT JOIN first USING (conv_id))
    SELECT qid, CAST(len(m) AS INTEGER) AS n_messages, array_to_string(m, chr(10)) AS messages, 256 AS max_tokens
    FROM whole"""

_VERSIONS = """WITH v0 AS (SELECT doc_id, text, lang FROM documents),
    v1 AS (SELECT doc_id, replace(text, chr(10), ' ') AS text, lang FROM documents WHERE lang <> 'es'),
    v2 AS (SELECT doc_id, text, lang FROM documents WHERE lang <> 'fr'),
    """ + " UNION ALL ".join(
    f"""SELECT '{a}-{b}' AS span, doc_id, CASE WHEN o.text IS NULL THEN 'insert' WHEN n.text IS NULL THEN 'delete'
      WHEN o.text <> n.text THEN 'update' END AS change FROM v{a} o FULL JOIN v{b} n USING (doc_id)"""
    for a, b in ((0, 1), (1, 2), (0, 2), (2, 0))
).join(["spans AS (", ")"]) + """
    SELECT span, change, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS doc_ids FROM spans WHERE change IS NOT NULL GROUP BY ALL"""


_RESPONSES = """
    SELECT conv_id || '-' || turn AS response_id, text AS content
    FROM conversations WHERE role = 'assistant'
    UNION ALL
    SELECT 'event-' || event_id, json_extract_string(props, '$.choices[0].message.content')
    FROM events"""

_CHANGES = """
    old AS (SELECT doc_id, text, lang FROM documents WHERE source <> 'src0'),
    new AS (SELECT doc_id, replace(text, chr(10), ' ') AS text, lang FROM documents
            WHERE lang <> 'es'),
    changes AS (
      SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
             CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete'
                  WHEN o.text <> n.text OR o.lang <> n.lang THEN 'update' END AS change
      FROM old o FULL JOIN new n ON o.doc_id = n.doc_id)"""


def _signature() -> str:
    rows = [
        ("doc_id", "'bigint'", "'bigint'", "true"),
        ("text", "'string'", "'string'", "true"),
        ("lang", "'string'", "'string'", "true"),
        ("n_chars", "'int'", "'bigint'", "false"),
        ("title", "'string'", "NULL", "false"),
        ("source", "NULL", "'string'", "false"),
    ]
    parts = []
    for name, expected, actual, ok in rows:
        nulls = "NULL" if actual == "NULL" else f"(SELECT count(*) - count({name}) FROM documents)"
        if name in ("doc_id", "text"):
            ok = f"{nulls} = 0"
        parts.append(
            f"SELECT '{name}' AS \"column\", {expected} AS expected, {actual} AS actual, "
            f"CAST({nulls} AS BIGINT) AS nulls, {ok} AS ok"
        )
    return " UNION ALL ".join(parts)


def oracle() -> dict[str, str]:
    pairs, chunks = f"WITH{PAIRS}", f"WITH{CHUNKS}"
    arrived = CHUNKS.replace("FROM documents", "FROM final")
    found = "WITH" + ",".join([PAIRS, CHUNKS, BM25, _hits(catalog.K)])
    two = "WITH" + ",".join([PAIRS, CHUNKS, BM25, _hits(2)])
    flow = _flow().replace("WITH", "WITH RECURSIVE", 1)
    scored = ",".join([flow, _TOXIC_MODEL, _overlap(1), _overlap(2), _values("run")])
    guard = f"SELECT doc_id, {_tok('text')} AS t FROM documents"
    return {
        "rag_token_f1": f"""{_flow()},{_overlap(1)}
            SELECT qid, questions, ground_truth, result, abstained,
              CASE WHEN len({_tok('result')}) > 0 AND len({_tok('ground_truth')}) > 0
              THEN CAST({_tok('result')} = {_tok('ground_truth')} AS INTEGER) END AS exact_match,
              f AS token_f1
            FROM answers JOIN over1 USING (qid)""",
        "page_text": _page_text(),
        "eval_pairs": f"{pairs} SELECT * FROM pairs",
        "chunk_window": f"{chunks} SELECT page_content, 'Document' AS type, id FROM chunks",
        "chunk_merge": _chunk_merge(False),
        "chunk_merge_split": _chunk_merge(True),
        "window_guard": f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens,
            len(t) > 512 AS over_window, array_to_string(t[1:512], ' ') AS model_input
            FROM ({guard})""",
        "window_report": f"""{chunks}, c AS (SELECT len({_tok('page_content')}) > 64 AS o FROM chunks)
            SELECT count(*) AS chunks, CAST(sum(CAST(o AS INTEGER)) AS BIGINT) AS truncated,
            round(avg(CAST(o AS INTEGER)), 6) AS truncated_share FROM c""",
        "missing_names": """SELECT doc_id, doc_id NOT IN (SELECT doc_id FROM labels) AS created
            FROM (SELECT DISTINCT doc_id FROM documents)""",
        "knn_exact": _knn(),
        "knn_cells_exact": _knn(),
        "describe_index": f"""SELECT count(*) AS row_count,
            CAST(min(len(embedding)) AS INTEGER) AS min_dimensions,
            CAST(max(len(embedding)) AS INTEGER) AS max_dimensions, count(*) - count(vec_id) AS null_keys,
            count(vec_id) - count(DISTINCT vec_id) AS repeated_keys,
            CAST({catalog.CELLS} AS BIGINT) AS cells
            FROM embeddings""",
        "embed_text": f"""{_vectors()} SELECT id, CAST(d AS INTEGER) AS dimension,
            round(CAST(w AS DOUBLE), 6) AS weight FROM vectors WHERE id IS NOT NULL""",
        "similarity_search": _nearest("SELECT item_id AS qid, text FROM benchmark", 2),
        "vector_retrieval": _nearest("SELECT qid, questions AS text FROM pairs", catalog.K, score=False),
        "reopened_index": _knn(),
        "reopened_bm25": f"{found} SELECT qid, CAST(rank AS INTEGER) AS rank, id, score FROM hits",
        "toxicity_scores": f"{_TOXICITY} SELECT * FROM flagged",
        "toxicity_ratio": f"""{_TOXICITY} SELECT count(toxicity) AS n,
            round(avg(CAST(toxic_flag AS INTEGER)), 6) AS toxic_ratio FROM flagged""",
        "bm25_index_terms": f"""{",".join([pairs, CHUNKS, BM25])}
            SELECT w AS term, df, round(idf, 6) AS idf FROM terms""",
        "bm25_topk": f"{found} SELECT qid, CAST(rank AS INTEGER) AS rank, id, score FROM hits",
        "project_mapped": f"{two} SELECT qid AS inputs, id, page_content AS context FROM hits",
        "stuffed_prompt": f"{found},{CONTEXTS} SELECT qid, prompt FROM prompts",
        "stuffed_budget": f"""{found},
            used AS (
              SELECT qid, rank, page_content,
                     sum(length(page_content)) OVER w + 2 * (rank - 1) AS upto
              FROM hits WINDOW w AS (PARTITION BY qid ORDER BY rank)),
            fitted AS (
              SELECT qid, string_agg(page_content, chr(10) || chr(10) ORDER BY rank) AS context
              FROM used WHERE upto <= 1200 GROUP BY qid)
            SELECT qid, coalesce(context, '') AS context
            FROM pairs LEFT JOIN fitted USING (qid)""",
        "chat_messages": f"""{found},{CONTEXTS} SELECT qid, 1 AS n_messages, 'user' AS role,
            prompt AS content FROM prompts""",
        "chat_render": _chat_render(),
        "extractive_answer": f"{_flow()} SELECT qid, result, abstained FROM answers",
        "abstain_rate": f"""{_flow()},{CONTEXTS},
            marks AS (
              SELECT abstained, len(list_intersect({_tok('p.questions')}, {_tok('context')})) > 0
                AS supported
              FROM answers JOIN prompts p USING (qid))
            SELECT count(*) AS n, CAST(sum(CAST(abstained AS INTEGER)) AS BIGINT) AS abstained,
              round(avg(CAST(abstained AS INTEGER)), 6) AS abstain_rate,
              round(avg(CAST(NOT supported AS INTEGER)), 6) AS unsupported_rate
            FROM marks""",
        "route_share": _route_share(),
        "route_stable": _route_stable(),
        "chat_requests": _CHAT_REQUESTS,
        "version_changes": _VERSIONS,
        "resumed_answers": f"""{found},{CONTEXTS} SELECT qid, CAST(length(prompt) AS VARCHAR) AS result,
            prompt IN (SELECT prompt FROM prompts WHERE qid % 2 = 0) AS reused, CAST(NULL AS VARCHAR) AS error FROM prompts""",
        "response_parse": _RESPONSES,
        "response_report": f"""SELECT count(*) AS responses,
            count(*) - count(content) AS malformed FROM ({_RESPONSES})""",
        "exact_match": f"""{_flow()} SELECT qid,
            CASE WHEN len({_tok('result')}) > 0 AND len({_tok('ground_truth')}) > 0
            THEN CAST({_tok('result')} = {_tok('ground_truth')} AS INTEGER) END AS exact_match,
            CASE WHEN len({_tok('ground_truth')}) > 0
            THEN CAST({_tok('upper(ground_truth)')} = {_tok('ground_truth')} AS INTEGER) END
              AS same_text
            FROM answers""",
        "token_f1": f"{_flow()},{_overlap(1)} SELECT qid, f AS token_f1 FROM over1",
        "rouge_n": f"""{_flow()},{_overlap(1)},{_overlap(2)}
            SELECT qid, o1.p AS rouge1_precision, o1.r AS rouge1_recall, o1.f AS rouge1_f1,
              o2.p AS rouge2_precision, o2.r AS rouge2_recall, o2.f AS rouge2_f1
            FROM over1 o1 JOIN over2 o2 USING (qid)""",
        "rouge_l": _rouge_l(),
        "readability": f"""WITH reads AS (SELECT doc_id, {_readability('text')} FROM documents)
            SELECT *, {_GRADES} FROM reads""",
        "faithfulness": _faithfulness("result", 3),
        "faithfulness_target": _faithfulness("ground_truth", 2),
        "relevance": _RELEVANCE,
        "judge_prompt": _judge_prompt(),
        "judge_parse": """WITH k AS (
              SELECT event_id, event_type,
                     CASE WHEN event_type <> 'error'
                     THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
              FROM events)
            SELECT event_id, CASE WHEN k BETWEEN 1 AND 5 THEN k END AS score,
              CASE WHEN event_type <> 'error' THEN event_type END AS justification,
              coalesce(k BETWEEN 1 AND 5, false) AS valid FROM k""",
        "eval_rows": f"{scored} SELECT * FROM vals",
        "metric_summary": f"""{scored},{_METRICS}
            SELECT run_id, metric, agg, round(value, 6) AS value FROM (
              SELECT run_id, metric, 'mean' AS agg, mean AS value FROM stats
              UNION ALL SELECT run_id, metric, 'variance', variance FROM stats
              UNION ALL SELECT run_id, metric, 'p90', p90 FROM stats
              UNION ALL SELECT run_id, metric, 'count', count FROM stats)""",
        "compare_runs": f"""{_two_runs()}
            SELECT 'top4' AS run_id, a.metric, round(avg(b.value), 6) AS mean,
              round(avg(a.value), 6) AS baseline_mean,
              round(avg(b.value) - avg(a.value), 6) AS difference,
              CAST(sum(CAST(b.value > a.value AS INTEGER)) AS BIGINT) AS wins,
              CAST(sum(CAST(b.value = a.value AS INTEGER)) AS BIGINT) AS ties,
              CAST(sum(CAST(b.value < a.value AS INTEGER)) AS BIGINT) AS losses
            FROM vals_a a JOIN vals_b b USING (qid, metric) GROUP BY a.metric""",
        "merged_summary": f"""{_two_runs()},
            every AS (SELECT metric, value FROM vals UNION ALL SELECT 'latency', 0 FROM pairs, range(2))
            SELECT metric, share, count(value) AS n, true AS near FROM every, (VALUES (0.5::DOUBLE), (0.9::DOUBLE)) s(share)
            GROUP BY metric, share HAVING count(value) > 0""",
        "compare_certainty": f"""{_two_runs()},
            paired AS (
              SELECT metric, qid, b.value - a.value AS d FROM vals_a a JOIN vals_b b USING (qid, metric)
              WHERE a.value IS NOT NULL AND b.value IS NOT NULL),
            drawn AS (
              SELECT qid, r, (CAST('0x' || substr(md5(CAST(qid AS VARCHAR) || '-' || r), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                / 4294967296::DOUBLE AS u
              FROM (SELECT DISTINCT qid FROM paired), range({evaluation.REPLICATES}) t(r)),
            weights AS (SELECT qid, r, {" + ".join(f"(u >= {c}::DOUBLE)::INT" for c in evaluation.POISSON)} AS w FROM drawn),
            means AS (SELECT metric, r, sum(w * d) / sum(w) AS mean FROM paired JOIN weights USING (qid) GROUP BY metric, r),
            ordered AS (SELECT metric, list_sort(list(mean)) AS m FROM means GROUP BY metric)
            SELECT 'top4' AS run_id, metric, difference, round(m[11], 6) AS low, round(m[len(m) - 10], 6) AS high,
              round(len(list_filter(m, lambda x: x > 0)) / len(m)::DOUBLE, 6) AS better_share
            FROM ordered JOIN (SELECT metric, round(avg(d), 6) AS difference FROM paired GROUP BY metric) USING (metric)""",
        "latency": f"""{found},{CONTEXTS} SELECT qid, CAST(length(prompt) AS VARCHAR) AS result,
            true AS timed, CAST(NULL AS VARCHAR) AS error FROM prompts""",
        "change_feed": f"WITH {_CHANGES} SELECT * FROM changes WHERE change IS NOT NULL",
        "change_counts": f"""WITH {_CHANGES} SELECT change, count(*) AS n FROM changes
            WHERE change IS NOT NULL GROUP BY change""",
        "sync_index": f"{chunks} SELECT id, doc_id, page_content FROM chunks",
        "sync_batches": f"WITH {_ARRIVED}, {arrived} SELECT id, doc_id, page_content FROM chunks",
        "live_bm25": f"""WITH {",".join([_ARRIVED, PAIRS, arrived, BM25, _hits(catalog.K)])}
            SELECT qid, CAST(rank AS INTEGER) AS rank, id, score FROM hits""",
        "live_vectors": _knn("""(
            SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN list_reverse(embedding) ELSE embedding END AS embedding
            FROM embeddings WHERE label IS DISTINCT FROM 0)"""),
        "save_roundtrip": f"""{chunks} SELECT id, page_content, CAST(NULL AS VARCHAR) AS type
            FROM chunks""",
        "run_history": f"""{_two_runs()}
            SELECT run_id, metric, count(*) AS n_rows, 'extractive' AS model
            FROM vals GROUP BY run_id, metric""",
        "signature_check": _signature(),
    }
