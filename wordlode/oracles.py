"""DuckDB SQL giving the same rows as the registered queries."""

from __future__ import annotations

from wordlode.functions.text import GB2312, WHITESPACE
from wordlode.profiles import LATIN

SEP = r"[^\p{L}]+"
ENDS = "[" + LATIN.sentence_delimiters.replace("\n", r"\n") + "]+"
# Ranks rest when all together move by less in a step.
TOLERANCE = 1e-5


def _words(text, lower=True):
    text = f"lower({text})" if lower else text
    return f"list_filter(string_split_regex({text}, '{SEP}'), lambda w: w <> '')"


def _clean(text):
    for pattern, replacement in LATIN.cleaning:
        pattern = pattern.replace("\t", r"\t").replace("\r", r"\r").replace("\n", r"\n")
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


def _with(*parts, recursive=False):
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


VOCAB = f"""vocab AS (SELECT DISTINCT key FROM (SELECT unnest({_words('text')}) AS key FROM benchmark)
  WHERE length(key) >= 5)"""
GAZ = f"gaz AS (SELECT DISTINCT unnest({_words('p_name')}) AS key FROM part)"
DOMAIN = """domain AS MATERIALIZED (SELECT * FROM documents
  SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id))"""
BACKGROUND = """background AS MATERIALIZED (SELECT * FROM documents
  ANTI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id))"""
STOP = f"""stop AS (SELECT txt FROM (SELECT txt, count(DISTINCT doc_id) AS n
  FROM (SELECT doc_id, unnest({_words('text')}) AS txt FROM documents)
  GROUP BY txt ORDER BY n DESC, txt LIMIT 50))"""
CANDIDATES = f"cand AS (SELECT DISTINCT unnest({_words('text')}) AS word FROM documents)"


def _freq(name, source, text="text"):
    return f"""{name} AS (SELECT word, count(*) AS freq
  FROM (SELECT unnest({_words(text)}) AS word FROM {source}) GROUP BY word)"""


def _sentences(source="documents", keys="doc_id", name="sent"):
    split = f"""list_filter(list_transform(string_split_regex(text, '{ENDS}'),
      lambda s: trim(s, '{WHITESPACE}')), lambda s: s <> '')"""
    return f"""{name} AS (SELECT {keys}, unnest(s) AS sentence, (generate_subscripts(s, 1) - 1)::INTEGER AS sent_id
  FROM (SELECT {keys}, {split} AS s FROM {source}))"""


def _sentence_words(keys="doc_id", lower=True, sent="sent", name="stok"):
    return f"""{name} AS (SELECT {keys}, sent_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos
  FROM (SELECT {keys}, sent_id, {_words('sentence', lower)} AS t FROM {sent}))"""


def _no_stop(keys="doc_id", name="kept"):
    """Words outside the stop list, positions counted anew."""
    return f"""{name} AS (SELECT {keys}, sent_id, word,
    row_number() OVER (PARTITION BY {keys}, sent_id ORDER BY pos) AS pos
  FROM stok WHERE word NOT IN (SELECT txt FROM stop))"""


def _pairs(window, source="stok", keys="doc_id", name="pairs"):
    on = " AND ".join(f"x.{k} = y.{k}" for k in [*keys.split(", "), "sent_id"])
    cols = ", ".join(f"x.{k}" for k in keys.split(", "))
    return f"""{name} AS (SELECT {cols}, x.word AS a, y.word AS b FROM {source} x JOIN {source} y
  ON {on} AND y.pos - x.pos BETWEEN 1 AND {window - 1})"""


def _both_ways(pairs="pairs", keys="", name="edges"):
    keys = keys + ", " if keys else ""
    return f"""{name} AS (SELECT {keys}a AS src, b AS dst FROM {pairs}
  UNION SELECT {keys}b, a FROM {pairs})"""


def _corpus_rank(edges="edges", name="ranks"):
    """Steps on one graph until it rests."""
    return f"""{name}_deg AS MATERIALIZED (SELECT src, count(*) AS deg FROM {edges} GROUP BY src),
{name}_flow AS MATERIALIZED (SELECT e.src, e.dst, 1.0::DOUBLE / deg AS share, 0.0::DOUBLE AS own
  FROM {edges} e JOIN {name}_deg d ON e.src = d.src
  UNION ALL SELECT src, src, 0.0, 1.0 FROM {name}_deg),
{name}_all AS (
  SELECT src AS node, 1.0::DOUBLE / n AS rank, n, true AS moving, 0 AS step
  FROM (SELECT src, count(*) OVER () AS n FROM {name}_deg)
  UNION ALL
  SELECT node, rank, n, sum(abs(rank - old)) OVER () >= {TOLERANCE}, step
  FROM (SELECT f.dst AS node, any_value(r.n) AS n, any_value(r.step) + 1 AS step,
      0.15 / any_value(r.n) + 0.85 * sum(r.rank * f.share) AS rank, sum(r.rank * f.own) AS old
    FROM {name}_all r JOIN {name}_flow f ON r.node = f.src
    WHERE r.moving AND r.step < 1000 GROUP BY f.dst)),
{name} AS MATERIALIZED (SELECT node AS word, rank AS weight FROM {name}_all WHERE NOT moving)"""


def _group_rank(flow, nodes, keys, name="ranks"):
    """Steps on many graphs, each until it rests.

    ``flow`` has keys, src, dst, share; ``nodes`` has keys, node.
    """
    cols = keys.split(", ")
    r_keys = ", ".join(f"r.{k}" for k in cols)
    on = " AND ".join(f"r.{k} = f.{k}" for k in cols)
    return f"""{name}_flow AS MATERIALIZED (SELECT {keys}, src, dst, share, 0.0::DOUBLE AS own FROM {flow}
  UNION ALL SELECT {keys}, node, node, 0.0, 1.0 FROM {nodes}),
{name}_all AS (
  SELECT {keys}, node, 1.0::DOUBLE / n AS rank, n, true AS moving, 0 AS step
  FROM (SELECT *, count(*) OVER (PARTITION BY {keys}) AS n FROM {nodes})
  UNION ALL
  SELECT {keys}, node, rank, n,
    sum(abs(rank - old)) OVER (PARTITION BY {keys}) >= {TOLERANCE}, step
  FROM (SELECT {r_keys}, f.dst AS node, any_value(r.n) AS n, any_value(r.step) + 1 AS step,
      0.15 / any_value(r.n) + 0.85 * sum(r.rank * f.share) AS rank, sum(r.rank * f.own) AS old
    FROM {name}_all r JOIN {name}_flow f ON {on} AND r.node = f.src
    WHERE r.moving AND r.step < 1000 GROUP BY {r_keys}, f.dst)),
{name} AS (SELECT {keys}, node, rank FROM {name}_all WHERE NOT moving)"""


def _word_rank(keys, edges="edges"):
    flow = f"""flow AS (SELECT {keys}, src, dst,
    1.0::DOUBLE / count(*) OVER (PARTITION BY {keys}, src) AS share FROM {edges})"""
    nodes = f"nodes AS (SELECT DISTINCT {keys}, src AS node FROM {edges})"
    return f"{flow},\n{nodes},\n{_group_rank('flow', 'nodes', keys)}"


def _aligned(d="SELECT word, freq FROM d0", b="SELECT word, freq FROM b0"):
    """Both frequency tables side by side, each counted once."""
    return f"""d AS MATERIALIZED ({d}), b AS MATERIALIZED ({b}),
aligned AS MATERIALIZED (
  SELECT word, sum(domain) AS domain, sum(background) AS background FROM (
    SELECT word, freq::DOUBLE AS domain, NULL::DOUBLE AS background FROM d
    UNION ALL SELECT word, NULL, freq::DOUBLE FROM b) GROUP BY word),
scale AS MATERIALIZED (SELECT sum(domain) / sum(background) AS by FROM aligned),
scaled AS MATERIALIZED (SELECT word, domain, background * scale.by AS background FROM aligned, scale)"""


def _word_tables(text="text"):
    return ",\n".join([
        DOMAIN, BACKGROUND, _freq("d0", "domain", text), _freq("b0", "background", text), _aligned(),
    ])


def _ratio(missing, aligned=None):
    fill = "coalesce({0}, 0) AS {0}" if missing == "zero" else "{0}"
    return (aligned or _word_tables()) + f""",
filled AS (SELECT word, {fill.format('domain')}, {fill.format('background')} FROM scaled),
totals AS MATERIALIZED (SELECT *, domain + background AS total FROM filled),
mass AS MATERIALIZED (SELECT sum(domain) / sum(total) AS alpha, avg(total) AS mean FROM totals),
ratio AS (SELECT word, domain, (domain + mean * alpha) / (total + mean) AS score FROM totals, mass)"""


LATIN_RULES = r"""regexp_matches(word, '\p{L}') AND length(word) >= 2 AND NOT regexp_matches(word, '[0-9_]')
  AND NOT contains(word, 'http') AND NOT contains(word, 'www') AND NOT contains(word, 'haha')
  AND right(word, 1) NOT IN ('q', 'v', 'j') AND left(word, 1) NOT IN ('ß', 'ç')
  AND right(word, 2) NOT IN ('ly', 'ed') AND left(word, 2) NOT IN ('un', 'zz')
  AND replace(word, left(word, 1), '') <> ''
  AND NOT (length(word) = 3 AND left(word, 1) IN ('x', 'y'))
  AND NOT (length(word) = 3 AND right(word, 1) IN ('a', 'o'))
  AND NOT (length(word) = 4 AND right(word, 2) IN ('os', 'as'))
  AND NOT (length(word) = 4 AND (contains(word, 'sh') OR contains(word, 'th')))"""


def _runs(text="lower(text)", source="documents", p=""):
    """Runs of letters, and how strongly neighbouring characters hold together."""
    return f"""{p}runs AS MATERIALIZED (SELECT run, count(*) AS n
  FROM (SELECT unnest(string_split_regex({text}, '{SEP}')) AS run FROM {source})
  WHERE run <> '' GROUP BY run),
{p}chars AS MATERIALIZED (SELECT run, n, i, substring(run, i, 1) AS ch
  FROM (SELECT run, n, unnest(range(1, length(run) + 1)) AS i FROM {p}runs)),
{p}ch AS (SELECT ch, sum(n) AS n FROM {p}chars GROUP BY ch),
{p}pair AS MATERIALIZED (SELECT x.ch AS a, y.ch AS b, sum(x.n)::BIGINT AS n FROM {p}chars x JOIN {p}chars y
  ON x.run = y.run AND y.i = x.i + 1 GROUP BY x.ch, y.ch),
{p}t AS MATERIALIZED (SELECT sum(n)::DOUBLE AS t FROM {p}pair),
{p}pmi AS MATERIALIZED (SELECT a, b, pair.n, ln(pair.n * t / (ca.n * cb.n)) AS pmi
  FROM {p}pair pair JOIN {p}ch ca ON ca.ch = a JOIN {p}ch cb ON cb.ch = b, {p}t WHERE pair.n / t > 1e-6)"""


def _pieces(p=""):
    """Runs cut where two characters hold together weakly, with their number."""
    return f"""{p}cuts AS (SELECT y.run, y.n, y.i, y.ch, coalesce(pmi.pmi < 0.5, true) AS brk
  FROM {p}chars y LEFT JOIN {p}chars x ON x.run = y.run AND x.i = y.i - 1
  LEFT JOIN {p}pmi pmi ON pmi.a = x.ch AND pmi.b = y.ch),
{p}numbered AS (SELECT *, sum(brk::INTEGER) OVER (PARTITION BY run ORDER BY i) AS piece FROM {p}cuts),
{p}pieces AS (SELECT run, n, string_agg(ch, '' ORDER BY i) AS word FROM {p}numbered GROUP BY run, n, piece),
{p}found AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS freq FROM {p}pieces, {p}t GROUP BY word, t
  HAVING sum(n) / t > 1e-6)"""


def _inside(outer, word, terms):
    """Places of dictionary terms inside words, by substring and equality."""
    return f"""SELECT {outer}.{word} AS word, i AS pos, l AS len, {terms}.key AS term
  FROM {outer}, unnest(range(1, length({outer}.{word}) + 1)) AS p(i),
    (SELECT DISTINCT length(key) AS l FROM {terms}) AS lens, {terms}
  WHERE i + l - 1 <= length({outer}.{word}) AND substring({outer}.{word}, i, l) = {terms}.key"""


VECTORS = """v AS (SELECT vec_id::VARCHAR AS word, embedding::DOUBLE[] AS vector, label FROM embeddings)"""


def _nearest(query="v", k=200):
    return f"""sims AS (SELECT query, word, sim FROM (
  SELECT q.word AS query, v.word AS word, round(list_cosine_similarity(q.vector, v.vector), 9) AS sim,
    row_number() OVER (PARTITION BY q.word
      ORDER BY round(list_cosine_similarity(q.vector, v.vector), 9) DESC, v.word) AS n
  FROM {query} q, v) WHERE n <= {k})"""


def _floor(least, alpha):
    return f"{least} + {1 - least!r} * (1 - exp(-{alpha} * c.depth))"


def _expansion(vectors=VECTORS, least=0.3, alpha=0.25, k=200):
    """Level by level until no word joins; a word's own link carries it to the next level."""
    return ",\n".join([vectors, _nearest(k=k).replace("sims AS (", "sims AS MATERIALIZED (", 1), f"""
links AS MATERIALIZED (SELECT query, word, sim, false AS own FROM sims WHERE NOT contains(word, '7')
  UNION ALL SELECT word, word, 1.0, true FROM v),
levels AS (
  SELECT word, 0 AS depth, 1.0::DOUBLE AS score, 0 AS step, true AS open FROM v WHERE label = 0
  UNION ALL
  SELECT word, depth, score, step, max(depth) OVER () = step
  FROM (SELECT l.word, min(CASE WHEN l.own THEN c.depth ELSE c.step + 1 END) AS depth,
      max(c.score * l.sim) AS score, c.step + 1 AS step
    FROM levels c JOIN links l ON l.query = c.word
    WHERE c.open AND (l.own OR (c.depth = c.step AND l.sim >= {_floor(least, alpha)}))
    GROUP BY l.word, c.step)),
cluster AS MATERIALIZED (SELECT word, depth, score FROM levels WHERE NOT open)"""])


DEEP = dict(least=0.02, alpha=0.05, k=4)
FIXPOINT = f"""kept AS MATERIALIZED (SELECT l.* FROM links l JOIN cluster c ON l.query = c.word
  WHERE l.own OR l.sim >= {_floor(0.02, 0.05)}),
raised AS (
  SELECT word, depth, score, true AS moving, 0 AS step FROM cluster
  UNION ALL
  SELECT word, depth, score, max(score - old) OVER () > 1e-12, step
  FROM (SELECT l.word, max(CASE WHEN l.own THEN c.depth END) AS depth, max(c.score * l.sim) AS score,
      max(CASE WHEN l.own THEN c.score END) AS old, c.step + 1 AS step
    FROM raised c JOIN kept l ON l.query = c.word WHERE c.moving GROUP BY l.word, c.step))"""


def _contrast():
    """Keywords of dt that are none of bt, both sentence tokens, without stop words."""
    def side(p, tokens):
        return ",\n".join([
            f"""{p}kept AS MATERIALIZED (SELECT doc_id, sent_id, word,
    row_number() OVER (PARTITION BY doc_id, sent_id ORDER BY pos) AS pos
  FROM {tokens} ANTI JOIN stop ON word = txt)""",
            _pairs(2, f"{p}kept", name=f"{p}p"), _both_ways(f"{p}p", name=f"{p}e").replace(
                f"{p}e AS (", f"{p}e AS MATERIALIZED (", 1),
            _corpus_rank(f"{p}e", f"{p}r"),
            f"""{p}k AS (SELECT *, row_number() OVER (ORDER BY round(weight, 9) DESC, word) AS n
  FROM {p}r WHERE length(word) >= 2)""",
        ])

    return ",\n".join([side("d", "dt"), side("b", "bt"), """sizes AS (
  SELECT least(n // 4, 1000) AS d, least(m // 8, 500, least(n // 4, 1000)) AS b
  FROM (SELECT count(*) AS n FROM domain), (SELECT count(*) AS m FROM background)),
keywords AS (SELECT word, weight FROM dk, sizes WHERE n <= d
  AND word NOT IN (SELECT word FROM bk, sizes WHERE n <= b))"""])


def _clean_sentences(source, name, tokens):
    """Cleaned lower-case sentences of a corpus and their words."""
    return ",\n".join([
        _sentences(source, name=name + "0"),
        f"""{name} AS MATERIALIZED (SELECT doc_id, sent_id, lower({_clean('sentence')}) AS text FROM {name}0)""",
        f"""{tokens} AS (SELECT doc_id, sent_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos
  FROM (SELECT doc_id, sent_id, {_words('text')} AS t FROM {name}))""",
    ])


def _draw(*parts):
    return f"('0x' || left(md5(concat_ws('/', {', '.join(parts)})), 13))::BIGINT"


def _walks(length, p, q, seed, attempts=40):
    """One walk from each word; some forty draws are enough for all to keep one."""
    most = max(1.0, 1 / p, 1 / q)
    mine = (str(seed), "s.start", "0", "s.step + 1", "attempt")
    return f"""arcs AS MATERIALIZED (SELECT a AS src, b AS dst FROM pairs UNION ALL SELECT b, a FROM pairs WHERE a <> b),
line AS MATERIALIZED (SELECT src, dst, total,
    row_number() OVER (PARTITION BY src ORDER BY {_draw('dst')} % 64, dst) - 1 AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY src) AS total FROM arcs)),
lines AS MATERIALIZED (SELECT DISTINCT src, total FROM line),
known AS MATERIALIZED (SELECT DISTINCT src, dst FROM arcs),
steps AS (
  SELECT src AS start, 0 AS step, NULL::VARCHAR AS prev, src AS node FROM lines
  UNION ALL
  SELECT start, step, prev, node FROM (
    SELECT s.start, s.step + 1 AS step, s.node AS prev, l.dst AS node,
      row_number() OVER (PARTITION BY s.start ORDER BY attempt) AS n
    FROM (SELECT s.*, attempt, {_draw(*mine, "'edge'")} % total AS place,
        {_draw(*mine, "'keep'")}::DOUBLE / {16**13}.0::DOUBLE AS chance
      FROM (SELECT steps.*, total FROM steps JOIN lines ON node = src WHERE step < {length}) s, range({attempts}) AS a(attempt)) s
    JOIN line l ON l.src = s.node AND l.place = s.place
    LEFT JOIN known k ON k.src = s.prev AND k.dst = l.dst
    WHERE s.step = 0 OR chance * {most!r}::DOUBLE < CASE WHEN l.dst = s.prev THEN {1 / p!r}::DOUBLE
      WHEN k.src IS NOT NULL THEN 1.0::DOUBLE ELSE {1 / q!r}::DOUBLE END)
  WHERE n = 1)"""


def _probable():
    """Most probable words of each kind of run, by tables of arcs; then the states of stretches that are no words."""
    follows = {"b": "me", "m": "me", "e": "bs", "s": "bs"}

    def way(state):
        ways = [f"{{'s': round(sc.{p} + t.{p}{state}, 9), 'o': {3 - 'bmes'.index(p)}, 'p': '{p}'}}" for p in "bmes" if state in follows[p]]
        return f"list_max([{', '.join(ways)}])"

    states = ", ".join(f"{way(s)} AS w_{s}" for s in "bmes")
    moved = ", ".join(f"round(w_{s}.s + e.{s}, 9) AS {s}" for s in "bmes")
    emitted = ", ".join(
        f"round(ln((coalesce(sum(n) FILTER (state = '{s}'), 0) + 0.5) / any_value(k.{s} + 0.5 * (k.alphabet + 1))), 9) AS {s}"
        for s in "bmes"
    )
    unknown = ", ".join(f"round(ln(0.5 / (k.{s} + 0.5 * (k.alphabet + 1))), 9) AS {s}" for s in "bmes")
    return f"""counted AS MATERIALIZED (SELECT key AS word, count(*) AS n, length(key) AS size FROM (
  SELECT unnest({_words('text')}) AS key FROM benchmark UNION ALL SELECT unnest({_words('p_name')}) FROM part) GROUP BY key),
whole AS MATERIALIZED (SELECT sum(n)::DOUBLE AS total FROM counted),
dict AS MATERIALIZED (SELECT word AS key, round(ln(n / total), 9) AS weight FROM counted, whole),
runs AS MATERIALIZED (SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest({_words('text')}) AS run FROM documents) GROUP BY doc_id, run),
kinds AS MATERIALIZED (SELECT DISTINCT run FROM runs),
inside AS MATERIALIZED ({_inside('kinds', 'run', 'dict')}),
ends AS (SELECT word AS run, pos + len - 1 AS stop, len, weight, true AS known FROM inside JOIN dict ON term = key
  UNION ALL
  SELECT run, i, 1, (SELECT round(ln(0.5 / total), 9) FROM whole), false
  FROM (SELECT run, unnest(range(1, length(run) + 1)) AS i FROM kinds) WHERE substring(run, i, 1) NOT IN (SELECT key FROM dict)),
arcs AS MATERIALIZED (SELECT run, stop, list({{'len': len, 'weight': weight, 'known': known}}) AS arcs FROM ends GROUP BY run, stop),
path AS (
  SELECT run, 0 AS stop, [0.0::DOUBLE] AS best, []::STRUCT(s DOUBLE, len BIGINT, known BOOLEAN)[] AS taken FROM kinds
  UNION ALL
  SELECT run, stop, list_append(best, way.s), list_append(taken, way) FROM (
    SELECT p.run, p.stop + 1 AS stop, best, taken, list_max(list_transform(a.arcs,
      lambda x: {{'s': round(best[p.stop + 2 - x.len] + x.weight, 9), 'len': x.len, 'known': x.known}})) AS way
    FROM path p JOIN arcs a ON a.run = p.run AND a.stop = p.stop + 1)),
back AS (
  SELECT run, length(run) AS stop, taken, NULL::BIGINT AS pos, NULL::BIGINT AS len, NULL::BOOLEAN AS known
  FROM path WHERE stop = length(run)
  UNION ALL
  SELECT run, stop - taken[stop].len, taken, stop - taken[stop].len + 1, taken[stop].len, taken[stop].known
  FROM back WHERE stop > 0),
cut AS MATERIALIZED (SELECT run, pos, len, known, substring(run, pos, len) AS piece FROM back WHERE pos IS NOT NULL),
loose AS (SELECT run, string_agg(piece, '' ORDER BY pos) AS stretch FROM (
    SELECT *, pos - row_number() OVER (PARTITION BY run ORDER BY pos) AS island FROM cut WHERE NOT known)
  GROUP BY run, island),
stretches AS MATERIALIZED (SELECT DISTINCT stretch FROM loose),
placed AS MATERIALIZED (SELECT CASE WHEN size = 1 THEN 's' WHEN i = 1 THEN 'b' WHEN i = size THEN 'e' ELSE 'm' END AS state,
    substring(word, i, 1) AS ch, n FROM (SELECT *, unnest(range(1, size + 1)) AS i FROM counted)),
kind AS MATERIALIZED (SELECT coalesce(sum(n) FILTER (state = 'b'), 0) AS b, coalesce(sum(n) FILTER (state = 'm'), 0) AS m,
    coalesce(sum(n) FILTER (state = 'e'), 0) AS e, coalesce(sum(n) FILTER (state = 's'), 0) AS s,
    count(DISTINCT ch) AS alphabet, (SELECT coalesce(sum(n), 0) FROM counted WHERE size = 2) AS two FROM placed),
turns AS MATERIALIZED (SELECT round(ln((b + 1) / (b + s + 2)), 9) AS eb, round(ln((s + 1) / (b + s + 2)), 9) AS es,
    eb AS sb, es AS ss, round(ln((b - two + 1) / (b + 2)), 9) AS bm, round(ln((two + 1) / (b + 2)), 9) AS be,
    round(ln((m - (b - two) + 1) / (m + 2)), 9) AS mm, round(ln((b - two + 1) / (m + 2)), 9) AS me FROM kind),
seen AS MATERIALIZED (SELECT ch, {emitted} FROM placed, kind k GROUP BY ch),
unseen AS MATERIALIZED (SELECT {unknown} FROM kind k),
letters AS MATERIALIZED (SELECT x.ch, coalesce(seen.b, u.b) AS b, coalesce(seen.m, u.m) AS m, coalesce(seen.e, u.e) AS e, coalesce(seen.s, u.s) AS s
  FROM (SELECT DISTINCT unnest(string_split(stretch, '')) AS ch FROM stretches) x LEFT JOIN seen ON seen.ch = x.ch, unseen u),
states AS (
  SELECT stretch, 1 AS i, round(t.eb + e.b, 9) AS b, -1e300::DOUBLE AS m, -1e300::DOUBLE AS e, round(t.es + e.s, 9) AS s,
    []::STRUCT(b VARCHAR, m VARCHAR, e VARCHAR, s VARCHAR)[] AS origin
  FROM stretches JOIN letters e ON e.ch = substring(stretch, 1, 1), turns t
  UNION ALL
  SELECT stretch, i, {moved}, list_append(origin, {{'b': w_b.p, 'm': w_m.p, 'e': w_e.p, 's': w_s.p}}) FROM (
    SELECT sc.stretch, sc.i + 1 AS i, origin, substring(sc.stretch, sc.i + 1, 1) AS next_ch, {states}
    FROM states sc, turns t WHERE sc.i < length(sc.stretch)) JOIN letters e ON e.ch = next_ch),
route AS (
  SELECT stretch, length(stretch) AS i, origin, CASE WHEN e >= s THEN 'e' ELSE 's' END AS state
  FROM states WHERE i = length(stretch)
  UNION ALL
  SELECT stretch, i - 1, origin, CASE state WHEN 'b' THEN origin[i - 1].b WHEN 'm' THEN origin[i - 1].m
    WHEN 'e' THEN origin[i - 1].e ELSE origin[i - 1].s END
  FROM route WHERE i > 1),
bounds AS (SELECT stretch, i, state, sum((state IN ('e', 's'))::INTEGER) OVER (PARTITION BY stretch ORDER BY i) - (state IN ('e', 's'))::INTEGER AS w
  FROM route),
parts AS (SELECT stretch, string_agg(substring(stretch, i, 1), '' ORDER BY i) AS token FROM bounds GROUP BY stretch, w),
tokens AS (SELECT run, piece AS token FROM cut WHERE known UNION ALL SELECT run, token FROM loose JOIN parts USING (stretch))"""


def _day(date, days):
    """The special words of a date, counted anew from the texts of its days."""
    return f"""SELECT '{date}' AS run_date, word, round(score, 6) AS score FROM ({_with(
        DOMAIN, BACKGROUND, f"picked AS (SELECT * FROM domain WHERE length(text) > 500 AND {days})",
        _clean_sentences("picked", "ds", "dt"), _clean_sentences("background", "bs", "bt"),
        _runs("text", "ds", "x_"), _pieces("x_"), _runs("text", "bs", "y_"), _pieces("y_"),
        _ratio("zero", _aligned("SELECT word, freq FROM x_found", "SELECT word, freq FROM y_found")),
    )} SELECT word, score FROM ratio WHERE {LATIN_RULES} ORDER BY round(score, 9) DESC, word LIMIT 100)"""


def _list(values):
    return "'" + values.replace("'", "''") + "'"


ORACLES = {
    "scan_project": "SELECT doc_id, lang, source FROM documents",
    "partition_scan": _with(DOMAIN) + "SELECT doc_id, length(text)::INTEGER AS n FROM domain",
    "decode_text": "SELECT doc_id, text FROM documents",
    "seed_match_filter": _with(
        VOCAB,
        f"""runs AS (SELECT doc_id, unnest({_words('text')}) AS run FROM documents),
kinds AS (SELECT DISTINCT run FROM runs),
hits AS (SELECT word, count(*) AS n FROM ({_inside('kinds', 'run', 'vocab')}) GROUP BY word)""",
    ) + """SELECT doc_id, sum(n)::BIGINT AS match_cnt FROM runs JOIN hits ON run = word
GROUP BY doc_id HAVING sum(n) > 5""",
    "term_matches": _with(
        VOCAB,
        f"""runs AS (SELECT page_id, unnest({_words('html')}) AS run FROM pages),
kinds AS (SELECT DISTINCT run FROM runs),
hits AS ({_inside('kinds', 'run', 'vocab')}),
found AS (SELECT page_id, term, count(*) AS n FROM runs JOIN hits ON run = word GROUP BY page_id, term)""",
    ) + """SELECT page_id, term, n, strpos(lower(html), term) - 1 AS first_pos
FROM found JOIN pages USING (page_id)""",
    "clean_chain": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
    "lexical_rules": _with(CANDIDATES) + f"SELECT word FROM cand WHERE {LATIN_RULES}",
    "charset_filter": _with(
        r"""pieces AS MATERIALIZED (SELECT DISTINCT unnest(string_split_regex(text, '[ \n]+')) AS word FROM documents)""",
        f"charset AS MATERIALIZED (SELECT unnest(string_split({_list(GB2312)}, '')) AS ch)",
        """marks AS MATERIALIZED (SELECT word, unnest(string_split(word, '')) AS ch FROM pieces WHERE word <> ''),
foreign_marks AS MATERIALIZED (SELECT ch FROM (SELECT DISTINCT ch FROM marks WHERE ch <> '') ANTI JOIN charset USING (ch)),
outside AS MATERIALIZED (SELECT DISTINCT word FROM marks SEMI JOIN foreign_marks USING (ch))""",
    ) + """SELECT word FROM pieces ANTI JOIN outside USING (word)
WHERE NOT regexp_matches(word, '[~!@#$%^&* ]')""",
    "sentence_split": _with(_sentences()) + "SELECT doc_id, sent_id, sentence FROM sent",
    "tokenize": f"""SELECT doc_id, (generate_subscripts(t, 1) - 1)::INTEGER AS pos, unnest(t) AS word
FROM (SELECT doc_id, {_words('text')} AS t FROM documents)""",
    "stop_word_filter": _with(STOP) + f"""SELECT d.doc_id, coalesce(tokens, '') AS tokens FROM documents d
LEFT JOIN (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS tokens
  FROM (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos
    FROM (SELECT doc_id, {_words('text')} AS t FROM documents))
  WHERE word NOT IN (SELECT txt FROM stop) GROUP BY doc_id) k ON d.doc_id = k.doc_id""",
    "token_views": _with(
        STOP, _sentences(), _sentence_words(),
        """per AS (SELECT sent.doc_id, sent.sent_id,
    coalesce(string_agg(word, ' ' ORDER BY pos), '') AS every,
    coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (word NOT IN (SELECT txt FROM stop)), '') AS kept
  FROM sent LEFT JOIN stok ON sent.doc_id = stok.doc_id AND sent.sent_id = stok.sent_id
  GROUP BY sent.doc_id, sent.sent_id)""",
    ) + """SELECT d.doc_id, coalesce(string_agg(every, ' ' ORDER BY sent_id), '') AS no_filter,
  coalesce(string_agg(kept, ' ' ORDER BY sent_id), '') AS no_stop_words,
  coalesce(string_agg(kept, ' ' ORDER BY sent_id), '') AS all_filters
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id GROUP BY d.doc_id""",
    "allowed_views": _with(
        STOP, STOP.replace("stop AS", "allowed AS", 1).replace("LIMIT 50", "LIMIT 400"), _sentences(), _sentence_words(),
        """per AS (SELECT sent.doc_id, sent.sent_id,
    coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (word NOT IN (SELECT txt FROM stop)), '') AS kept,
    coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (word NOT IN (SELECT txt FROM stop)
      AND word IN (SELECT txt FROM allowed)), '') AS chosen
  FROM sent LEFT JOIN stok ON sent.doc_id = stok.doc_id AND sent.sent_id = stok.sent_id
  GROUP BY sent.doc_id, sent.sent_id)""",
    ) + """SELECT d.doc_id, coalesce(string_agg(kept, ' ' ORDER BY sent_id), '') AS no_stop_words,
  coalesce(string_agg(chosen, ' ' ORDER BY sent_id), '') AS all_filters
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id GROUP BY d.doc_id""",
    "dictionary_segment": _with(
        VOCAB, GAZ,
        f"""dict AS (SELECT key FROM vocab UNION SELECT key FROM gaz),
runs AS (SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest({_words('text')}) AS run FROM documents) GROUP BY doc_id, run),
kinds AS (SELECT DISTINCT run FROM runs),
longest AS (SELECT word, pos, max(len) AS len FROM ({_inside('kinds', 'run', 'dict')}) GROUP BY word, pos),
step AS (SELECT run, i AS pos, coalesce(len, 1) AS len
  FROM (SELECT run, unnest(range(1, length(run) + 1)) AS i FROM kinds)
  LEFT JOIN longest ON run = word AND i = pos),
walk AS (SELECT run, 1 AS pos FROM kinds
  UNION ALL SELECT w.run, w.pos + s.len FROM walk w JOIN step s ON w.run = s.run AND w.pos = s.pos),
pieces AS (SELECT w.run, substring(w.run, w.pos, s.len) AS token
  FROM walk w JOIN step s ON w.run = s.run AND w.pos = s.pos)""",
        recursive=True,
    ) + """SELECT doc_id, token, sum(n)::BIGINT AS n FROM runs JOIN pieces USING (run) GROUP BY doc_id, token""",
    "probable_segment": _with(_probable(), recursive=True)
    + "SELECT doc_id, token, sum(n)::BIGINT AS n FROM runs JOIN tokens USING (run) GROUP BY doc_id, token",
    "word_freq": _with(_freq("f", "documents")) + "SELECT word, freq FROM f",
    "term_counts": _with(
        _sentences("conversations", "conv_id, turn"), _sentence_words("conv_id, turn")
    ) + "SELECT conv_id, turn, sent_id, word, count(*) AS n FROM stok GROUP BY conv_id, turn, sent_id, word",
    "pair_pmi": _with(_runs()) + "SELECT a, b, n, round(pmi, 6) AS pmi FROM pmi",
    "new_words": _with(_runs(), _pieces()) + "SELECT word, freq FROM found",
    "aligned_vocabulary": _with(_word_tables()) + "SELECT word, domain, background FROM aligned",
    "scaled_background": _with(_word_tables())
    + "SELECT word, round(background, 6) AS background FROM scaled",
    "smoothed_ratio_zero": _with(_ratio("zero")) + "SELECT word, round(score, 6) AS score FROM ratio",
    "smoothed_ratio_null": _with(_ratio("null")) + "SELECT word, round(score, 6) AS score FROM ratio",
    "specific_words": _with(_ratio("zero", _word_tables(_clean("text"))))
    + f"""SELECT word, domain::BIGINT AS freq, round(score, 6) AS score FROM ratio WHERE {LATIN_RULES}
ORDER BY round(score, 9) DESC, word LIMIT 100""",
    "keyword_budget": _with(DOMAIN, BACKGROUND) + """SELECT least(n // 4, 1000) AS domain_budget,
  least(m // 8, 500, least(n // 4, 1000)) AS background_budget
FROM (SELECT count(*) AS n FROM domain), (SELECT count(*) AS m FROM background)""",
    "phrase_count": "SELECT doc_id, " + ", ".join(
        f"((length(t) - length(replace(t, '{p}', ''))) // {len(p)})::BIGINT AS {n}"
        for n, p in {"n_the": "the", "n_de": "de ", "n_on_the": "on the", "n_haha": "haha"}.items()
    ) + " FROM (SELECT doc_id, lower(text) AS t FROM documents)",
    "window_pairs": _with(_sentences(), _sentence_words(), _pairs(3))
    + "SELECT a, b, count(*) AS n FROM pairs GROUP BY a, b",
    "cooccur_graph": _with(
        CANDIDATES, _sentences(), _sentence_words(), _pairs(3),
        f"good AS (SELECT word FROM cand WHERE {LATIN_RULES})",
    ) + """SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM pairs
WHERE a IN (SELECT word FROM good) AND b IN (SELECT word FROM good)""",
    "pagerank_corpus": _with(
        _sentences(), _sentence_words(), _pairs(2), _both_ways(), _corpus_rank(), recursive=True
    ) + "SELECT word, round(weight, 9) AS weight FROM ranks",
    "pagerank_doc": _with(
        STOP, _sentences("conversations", "conv_id, turn"), _sentence_words("conv_id, turn"),
        _pairs(2, "stok", "conv_id, turn"),
        """good AS (SELECT * FROM pairs WHERE a NOT IN (SELECT txt FROM stop)
  AND b NOT IN (SELECT txt FROM stop))""",
        _both_ways("good", "conv_id, turn"), _word_rank("conv_id, turn"), recursive=True,
    ) + "SELECT conv_id, turn, node AS word, round(rank, 9) AS weight FROM ranks",
    "doc_keywords": _with(
        STOP, _sentences(), _sentence_words(), _no_stop(), _pairs(2, "kept"),
        _both_ways("pairs", "doc_id"), _word_rank("doc_id"), recursive=True,
    ) + """SELECT doc_id, (n - 1)::INTEGER AS pos, node AS word, round(rank, 9) AS weight
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(rank, 9) DESC, node) AS n
  FROM ranks WHERE length(node) >= 2) WHERE n <= 6""",
    "keyphrases": _with(
        STOP, _sentences(), _sentence_words(lower=False), _no_stop(), _pairs(2, "kept"),
        _both_ways("pairs", "doc_id"), _word_rank("doc_id"),
        """top AS (SELECT doc_id, node FROM (SELECT *,
    row_number() OVER (PARTITION BY doc_id ORDER BY round(rank, 9) DESC, node) AS n FROM ranks) WHERE n <= 12),
marked AS (SELECT s.*, pos - row_number() OVER (PARTITION BY s.doc_id, sent_id ORDER BY pos) AS island
  FROM stok s JOIN top ON s.doc_id = top.doc_id AND s.word = top.node),
phrases AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS phrase
  FROM marked GROUP BY doc_id, sent_id, island HAVING count(*) > 1)""",
        recursive=True,
    ) + """SELECT DISTINCT doc_id, phrase FROM phrases JOIN documents USING (doc_id)
WHERE (length(text) - length(replace(text, phrase, ''))) // length(phrase) >= 2""",
    "sentence_similarity": _with(
        _sentences(),
        f"""s AS (SELECT doc_id, sent_id, {_words('sentence')} AS w FROM sent),
p AS (SELECT x.doc_id, x.sent_id, x.w AS a, y.w AS b,
    len(list_distinct(x.w || y.w)) AS n_union, len(list_intersect(x.w, y.w)) AS n_shared
  FROM s x JOIN s y ON x.doc_id = y.doc_id AND y.sent_id = x.sent_id + 1)""",
    ) + """SELECT doc_id, sent_id, n_union::INTEGER AS n_union, n_shared::INTEGER AS n_shared,
  CASE WHEN n_shared > 0 AND len(a) * len(b) > 1
    THEN round(n_shared / (ln(len(a)) + ln(len(b))), 6) ELSE 0 END AS similarity FROM p""",
    "sentence_rank": _with(
        _sentences(), _sentence_words(),
        """size AS (SELECT doc_id, sent_id, count(*) AS n FROM stok GROUP BY doc_id, sent_id),
post AS (SELECT DISTINCT doc_id, sent_id, word FROM stok),
shared AS (SELECT x.doc_id, x.sent_id AS src, y.sent_id AS dst, count(*) AS c
  FROM post x JOIN post y ON x.doc_id = y.doc_id AND x.word = y.word GROUP BY x.doc_id, x.sent_id, y.sent_id),
sim AS (SELECT s.doc_id, src, dst, c / (ln(a.n) + ln(b.n)) AS sim FROM shared s
  JOIN size a ON a.doc_id = s.doc_id AND a.sent_id = src
  JOIN size b ON b.doc_id = s.doc_id AND b.sent_id = dst WHERE a.n * b.n > 1),
mass AS (SELECT doc_id, src, sum(sim) AS strength FROM sim GROUP BY doc_id, src),
nodes AS (SELECT doc_id, sent_id AS node FROM sent),
alone AS (SELECT doc_id, node FROM nodes ANTI JOIN mass ON nodes.doc_id = mass.doc_id AND node = src),
flow AS (SELECT sim.doc_id, sim.src, dst, sim / strength AS share
  FROM sim JOIN mass ON sim.doc_id = mass.doc_id AND sim.src = mass.src
  UNION ALL SELECT alone.doc_id, alone.node, nodes.node,
    1.0::DOUBLE / count(*) OVER (PARTITION BY alone.doc_id, alone.node)
  FROM alone JOIN nodes ON alone.doc_id = nodes.doc_id)""",
        _group_rank("flow", "nodes", "doc_id"), recursive=True,
    ) + """SELECT r.doc_id, node AS sent_id, round(coalesce(strength, 0), 6) AS strength, round(rank, 9) AS weight
FROM ranks r LEFT JOIN mass m ON r.doc_id = m.doc_id AND node = src""",
    "sentence_partners": _with(
        _sentences(), _sentence_words(),
        """size AS MATERIALIZED (SELECT doc_id, sent_id, count(*) AS n FROM stok GROUP BY doc_id, sent_id),
post AS MATERIALIZED (SELECT DISTINCT doc_id, sent_id, word FROM stok),
shared AS (SELECT x.doc_id, x.sent_id, y.sent_id AS partner, count(*) AS c FROM post x JOIN post y
  ON x.doc_id = y.doc_id AND x.word = y.word AND x.sent_id <> y.sent_id GROUP BY x.doc_id, x.sent_id, y.sent_id),
sim AS (SELECT s.doc_id, s.sent_id, partner, c / (ln(a.n) + ln(b.n)) AS similarity FROM shared s
  JOIN size a ON a.doc_id = s.doc_id AND a.sent_id = s.sent_id
  JOIN size b ON b.doc_id = s.doc_id AND b.sent_id = partner WHERE a.n * b.n > 1)""",
    ) + """SELECT doc_id, sent_id, rank::INTEGER AS rank, partner, round(similarity, 6) AS similarity
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, sent_id
    ORDER BY round(similarity, 9) DESC, partner) AS rank FROM sim) WHERE rank <= 3""",
    "sentence_pairs": _with(
        _sentences(), f"""bag AS (SELECT doc_id, sent_id, {_words('sentence')} AS w FROM sent),
class AS MATERIALIZED (SELECT doc_id, min(sent_id) AS a, count(*) AS copies, len(w) AS n, list_sort(list_distinct(w)) AS words
  FROM bag WHERE len(w) > 0 GROUP BY doc_id, len(w), list_sort(list_distinct(w))),
post AS MATERIALIZED (SELECT doc_id, a, n, copies, unnest(words) AS word FROM class),
shared AS (SELECT x.doc_id, x.a, y.a AS b, any_value(x.copies) AS copies_a, any_value(y.copies) AS copies_b,
    count(*)::INTEGER AS shared, any_value(x.n) AS n, any_value(y.n) AS m
  FROM post x JOIN post y ON x.doc_id = y.doc_id AND x.word = y.word AND (x.a < y.a OR x.a = y.a AND x.copies > 1)
  GROUP BY x.doc_id, x.a, y.a)""",
    ) + """SELECT doc_id, a, b, copies_a, copies_b, shared, round(shared / (ln(n) + ln(m)), 6) AS similarity FROM shared
WHERE n * m > 1 AND round(shared / (ln(n) + ln(m)), 9) >= 1.2""",
    "keyword_contrast": _with(
        STOP, DOMAIN, BACKGROUND,
        _sentences("domain", name="ds"), _sentence_words(sent="ds", name="dt"),
        _sentences("background", name="bs"), _sentence_words(sent="bs", name="bt"), _contrast(),
        recursive=True,
    ) + "SELECT word, round(weight, 9) AS weight FROM keywords",
    "random_walks": _with(
        _sentences(), _sentence_words(), _pairs(2), _walks(5, 1.25, 0.8, 7), recursive=True
    ) + "SELECT start, 0 AS walk, step, node FROM steps",
    "term_ids": _with(CANDIDATES) + "SELECT word, row_number() OVER (ORDER BY word) - 1 AS id FROM cand",
    "vector_topk": _with(VECTORS, _nearest(k=10)) + "SELECT query, word, round(sim, 6) AS sim FROM sims",
    "centroid_shift": _with(
        VECTORS,
        """parts AS (SELECT word, label, unnest(vector) AS x, generate_subscripts(vector, 1) AS i FROM v),
shift AS (SELECT i, avg(x) FILTER (label = 0) - avg(x) FILTER (label = 1) AS x FROM parts GROUP BY i),
q AS (SELECT word, list(parts.x + shift.x ORDER BY i) AS vector FROM parts JOIN shift USING (i) GROUP BY word)""",
        _nearest("q", 5),
    ) + "SELECT query, word, round(sim, 6) AS sim FROM sims",
    "expand_scored": _with(_expansion(), recursive=True)
    + "SELECT word, depth, round(score, 6) AS score FROM cluster WHERE score >= 0.3",
    "expand_deep": _with(_expansion(**DEEP), recursive=True)
    + "SELECT word, depth, round(score, 6) AS score FROM cluster WHERE score >= 0.02",
    "expand_fixpoint": _with(_expansion(**DEEP), FIXPOINT, recursive=True)
    + "SELECT word, depth, round(score, 6) AS score FROM raised WHERE NOT moving AND score >= 0.02",
    "expand_members": _with(_expansion(), recursive=True) + "SELECT word FROM cluster",
    "final_score": _with(_expansion(), recursive=True)
    + """SELECT c.word, round((label + 1) / 10.0::DOUBLE * score ** 2, 6) AS score
FROM cluster c LEFT JOIN v ON c.word = v.word AND label <> 3 WHERE score >= 0.3""",
    "word_vectors": _with(DOMAIN, _freq("f", "domain"))
    + "SELECT word, 16 AS n_dims, false AS broken FROM f WHERE freq >= 5",
    "seed_vectors": _with(VOCAB, DOMAIN, _freq("f", "domain"))
    + "SELECT word, 16 AS n_dims, false AS broken FROM f SEMI JOIN vocab ON key = word WHERE freq >= 5",
    "information_cells": _with(
        DOMAIN, _freq("f", "domain"),
        f"""tok AS MATERIALIZED (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos
  FROM (SELECT doc_id, {_words('text')} AS t FROM domain)),
good AS (SELECT word FROM f WHERE freq >= 5),
near AS (SELECT x.word AS a, y.word AS b FROM tok x JOIN tok y
  ON x.doc_id = y.doc_id AND y.pos - x.pos BETWEEN 1 AND 5
  WHERE x.word IN (SELECT word FROM good) AND y.word IN (SELECT word FROM good)),
cells AS MATERIALIZED (SELECT a, b, count(*) AS n
  FROM (SELECT a, b FROM near UNION ALL SELECT b, a FROM near) GROUP BY a, b),
margin AS (SELECT a AS word, sum(n)::BIGINT AS n FROM cells GROUP BY a),
valued AS (SELECT c.a, c.b, c.n, ln(c.n * (SELECT sum(n) FROM cells)::DOUBLE / (x.n * y.n::DOUBLE)) AS value
  FROM cells c JOIN margin x ON x.word = c.a JOIN margin y ON y.word = c.b)""",
    ) + "SELECT a, b, n, round(value, 6) AS value FROM valued WHERE value > 0",
    "text_vectors": _with(
        f"""tok AS MATERIALIZED (SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest({_words('text')}) AS word FROM documents) GROUP BY doc_id, word),
freq AS (SELECT word, sum(n) AS n FROM tok GROUP BY word),
known AS (SELECT word, 0.001 / (0.001 + n / (SELECT sum(n) FROM freq)::DOUBLE) AS weight,
    {_draw('word')} % (SELECT count(*) FROM embeddings) AS place FROM freq),
parts AS (SELECT doc_id, n * weight AS share, unnest(embedding::DOUBLE[]) AS x,
    generate_subscripts(embedding, 1)::INTEGER - 1 AS dim
  FROM tok JOIN known USING (word) JOIN embeddings ON vec_id = place)""",
    ) + """SELECT doc_id, dim::INTEGER AS dim, round(sum(share * x) / sum(share), 6) AS x
FROM parts GROUP BY doc_id, dim""",
    "index_recall": "SELECT (10 * count(*))::BIGINT AS expected, true AS enough FROM embeddings",
    "mined_terms": _with(
        STOP, VOCAB, GAZ, DOMAIN, BACKGROUND,
        _clean_sentences("domain", "ds", "dt"), _clean_sentences("background", "bs", "bt"),
        _runs("text", "ds", "x_"), _pieces("x_"), _runs("text", "bs", "y_"), _pieces("y_"),
        _ratio("zero", _aligned("SELECT word, freq FROM x_found", "SELECT word, freq FROM y_found")),
        _contrast(),
        f"""named AS (SELECT word AS key, 'candidate' AS origin FROM ratio WHERE {LATIN_RULES}
  UNION SELECT word, 'keyword' FROM keywords WHERE {LATIN_RULES}
  UNION SELECT key, 'vocabulary' FROM vocab UNION SELECT key, 'gazetteer' FROM gaz)""",
        recursive=True,
    ) + "SELECT key, string_agg(origin, '+' ORDER BY origin) AS origin FROM named GROUP BY key",
    "mined_screen": _with(_expansion(VECTORS.replace("vec_id::VARCHAR", "'a' || vec_id || 'b'")), """special AS (
  SELECT c.word, (label + 1) / 10.0::DOUBLE * score AS score FROM cluster c JOIN v USING (word) WHERE score >= 0.3),
known AS (SELECT vec_id || 'b' AS key FROM embeddings WHERE label = 1
  UNION SELECT 'a' || vec_id || 'bc' FROM embeddings WHERE label = 1),
places AS (SELECT 'a' || vec_id AS key FROM embeddings WHERE label = 2)""", recursive=True)
    + """SELECT word, round(score, 6) AS score FROM special
WHERE NOT contains(word, '7') AND NOT EXISTS (SELECT 1 FROM known WHERE contains(word, key))
  AND NOT EXISTS (SELECT 1 FROM places WHERE contains(word, key))
  AND NOT EXISTS (SELECT 1 FROM known WHERE starts_with(key, word))
ORDER BY round(special.score, 9) DESC, word LIMIT 100""",
    "daily_words": _day("20240101", "doc_id % 2 = 0") + " UNION ALL " + _day("20240102", "true"),
    "exclude_known": _with(CANDIDATES, VOCAB)
    + f"SELECT word FROM cand WHERE word NOT IN (SELECT word FROM ({_inside('cand', 'word', 'vocab')}))",
    "exclude_gazetteer": _with(CANDIDATES, GAZ)
    + f"SELECT word FROM cand WHERE word NOT IN (SELECT word FROM ({_inside('cand', 'word', 'gaz')}))",
    "exclude_prefix": _with(CANDIDATES, VOCAB) + """SELECT word FROM cand
WHERE word NOT IN (SELECT left(key, l) FROM vocab, unnest(range(1, length(key) + 1)) AS p(l))""",
}
