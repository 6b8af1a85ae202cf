"""DuckDB SQL that says what queries must return, where SQL can say it."""

from __future__ import annotations

import math

from . import conversations, jaccard, mixing, negatives, quality, substrings, topk, urls


def url_filters() -> str:
    rules = sorted(urls.rule_set(), key=lambda r: (r.kind == "host", r.length if r.kind == "host" else 0, r.verdict == "allow"), reverse=True)
    text = [r.regex.replace("'", "''") for r in rules]
    whens = lambda value: " ".join(f"WHEN regexp_matches(hp, '{x}') THEN {value(r)}" for r, x in zip(rules, text))
    named = whens(lambda r: f"'{r.name}'" if r.name else "NULL")
    verdicts = whens(lambda r: f"'{r.verdict}'")
    return f"""WITH parts AS (SELECT page_id,
      translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    whole AS (SELECT *, host || path AS hp FROM parts)
    SELECT page_id, host, path, CASE {named} END AS rule, CASE {verdicts} ELSE 'allow' END AS verdict FROM whole"""


WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '')"


def mixture() -> str:
    weights = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    return f"""WITH sized AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
    sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    ranked AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM sums),
    weighed AS (SELECT *, CASE place % {len(mixing.WEIGHTS)} {weights} END AS w, {mixing.MOST_REPEATS} * source_size AS cap FROM ranked),
    level AS (SELECT *, least({mixing.SHARE} * sum(source_size) OVER (), sum(cap) OVER ()) AS total, sum(w) OVER () AS w_all,
      coalesce(sum(cap) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before FROM weighed
      WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    filled AS (SELECT *, (CAST(total AS DOUBLE) - cap_before) * w >= cap * (w_all - w_before) AS is_full FROM level),
    aimed AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE),
      (CAST(total AS DOUBLE) - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0)) * w / sum(CASE WHEN NOT is_full THEN w END) OVER ()) END AS target FROM filled),
    rated AS (SELECT d.doc_id, d.size, a.source_size, a.target, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0 END AS rate,
      CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / {float(2**52)} AS chance
      FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source)
    SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM rated"""


def quality_rules() -> str:
    n = len(quality.RULES)
    votes = ", ".join(f"CASE WHEN {r.junk} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v{i}" for i, r in enumerate(quality.RULES))
    names = ", ".join(f"v{i}" for i in range(n))

    def odds(good: str, junk: str) -> str:
        return f"ln({good}) - ln({junk})"

    start = ", ".join(
        f"CAST({math.log(g) - math.log(j)} AS DOUBLE) AS {kind}{i}"
        for i in range(n) for kind, g, j in zip(("j", "z", "g"), quality.BELIEVED["good"], quality.BELIEVED["junk"])
    )
    bias = math.log(quality.START_QUALITY / (1 - quality.START_QUALITY))
    score = "bias + " + " + ".join(f"CASE v{i} WHEN -1 THEN j{i} WHEN 1 THEN g{i} ELSE z{i} END" for i in range(n))
    posterior = f"1 / (1 + exp(-({score})))"
    sums = ", ".join(
        f"sum(CASE WHEN v{i} = {v} THEN p * n ELSE 0 END) AS a{k}{i}, sum(CASE WHEN v{i} = {v} THEN n ELSE 0 END) AS n{k}{i}"
        for i in range(n) for k, v in (("j", -1), ("g", 1))
    )
    bg, bj = quality.BELIEVED["good"], quality.BELIEVED["junk"]
    b = quality.BELIEF
    model = []
    for i in range(n):
        good = {"j": f"aj{i}", "z": f"(good - aj{i} - ag{i})", "g": f"ag{i}"}
        every = {"j": f"nj{i}", "z": f"(total - nj{i} - ng{i})", "g": f"ng{i}"}
        for k, x, y in zip("jzg", bg, bj):
            g = f"(greatest(0, {good[k]}) + {b} * total * {x}) / (good + {b} * total)"
            j = f"(greatest(0, {every[k]} - {good[k]}) + {b} * total * {y}) / (total - good + {b} * total)"
            model.append(f"{odds(g, j)} AS {k}{i}")
    share = f"least({quality.MOST}, greatest({quality.LEAST}, good / total))"
    steps, last = [f"m0 AS (SELECT CAST({bias} AS DOUBLE) AS bias, {start})"], "m0"
    for k in range(1, quality.ITERATIONS + 1):
        steps.append(f"e{k} AS MATERIALIZED (SELECT sum(n) AS total, sum(p * n) AS good, {sums} FROM (SELECT *, {posterior} AS p FROM patterns, {last}))")
        steps.append(f"m{k} AS MATERIALIZED (SELECT ln({share} / (1 - {share})) AS bias, {', '.join(model)} FROM e{k})")
        last = f"m{k}"
    return rf"""WITH split AS (SELECT doc_id, {WORDS} AS words,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines, row_number() OVER () AS r FROM documents),
    grams AS (SELECT r, i, list_extract(words, i) || ' ' || list_extract(words, i + 1) || ' ' || list_extract(words, i + 2) AS gram
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
    covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
    base AS (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n_words, array_to_string(words, '') AS joined,
      CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines FROM split),
    measured AS (SELECT doc_id, n_words, n_lines, n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
      CAST(length(joined) AS BIGINT) AS word_chars,
      CAST(length(joined) - length(regexp_replace(joined, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      length(regexp_replace(joined, '[^\p{{L}}]+', '', 'g')) AS n_letters,
      length(joined) - length(regexp_replace(joined, '[.!?]', '', 'g')) AS n_ends FROM base b LEFT JOIN covered c ON b.r = c.r),
    voted AS (SELECT *, {votes} FROM measured),
    patterns AS (SELECT {names}, count(*) AS n FROM voted GROUP BY ALL),
    {', '.join(steps)},
    judged AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
      {posterior} AS quality FROM voted, {last})
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND quality >= 0.5 AS kept, round(quality, 6) AS quality FROM judged"""


def nearest() -> str:
    return f"""WITH whole AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({topk.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id % {topk.QUERY_STEP} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM
      (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= {topk.K}"""


def repeats() -> str:
    k = substrings.WINDOW
    return f"""WITH split AS (SELECT doc_id, {WORDS} AS words FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(words[i:i + {k - 1}], ' ') AS g
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - {k - 2})) AS i FROM split)),
    repeated AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, i + j AS i FROM repeated, (SELECT unnest(range(0, {k})) AS j)),
    kept AS (SELECT w.doc_id, count(*) AS n, string_agg(w.word, ' ' ORDER BY w.i) AS text
      FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split) w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i
      GROUP BY w.doc_id)
    SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
      FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id"""


def groups() -> str:
    k, percent = jaccard.WORDS, jaccard.PERCENT
    lowered = WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return f"""WITH RECURSIVE split AS (SELECT doc_id, {lowered} AS words FROM documents),
    shingles AS (SELECT DISTINCT doc_id, g FROM (
      SELECT doc_id, array_to_string(words[i:i + {k - 1}], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - {k - 2})) AS i FROM split WHERE len(words) >= {k})
      UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM split WHERE len(words) BETWEEN 1 AND {k - 1})),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o.n >= {percent} * (x.n + y.n - o.n)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT s.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id
      FROM split s LEFT JOIN sizes z ON z.doc_id = s.doc_id LEFT JOIN least l ON l.a = s.doc_id"""


def hard_negatives() -> str:
    n = negatives
    return f"""WITH whole AS (SELECT vec_id, CASE WHEN vec_id % {n.MOVED_STEP} = 0 THEN (label + 1) % {n.LABELS} ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor({n.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    pairs AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
      FROM whole a JOIN whole c ON a.vec_id % {n.ANCHOR_STEP} = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
    liked AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM
      (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM pairs WHERE same) WHERE place <= {n.POSITIVES}),
    hard AS (SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
      FROM liked JOIN pairs USING (anchor_id) WHERE NOT same AND {n.LEAST_PERCENT} * positive_score <= {n.MOST_PERCENT} * score AND score <= positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= {n.NEGATIVES}"""


def conversations_repair() -> str:
    c = conversations
    # CRC-32 bit by bit: each character is followed by eight marks.
    crc = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(name, ''),
      lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""
    never = 1000000
    own = {0: "CASE initial WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE {n} END", 1: "CASE initial WHEN 'u' THEN b2 ELSE {n} END", 2: "CASE initial WHEN 'a' THEN b3 ELSE {n} END"}
    own[3] = own[1]
    keep = {q: own[q].format(n=never) for q in range(4)}
    rows = ", ".join(
        f"least({c.DELETE} + b{q}, CASE WHEN fault IN ('b', 'd') THEN {never} ELSE extra + least({c.KEEP} + {keep[q]}, {c.REROLE} + b{c._AFTER[q]}) END) AS r{q}" for q in range(4)
    )
    i = c.INSERT
    before = f"least(r0, {i} + r2, {2 * i} + r3) AS b0, least(r1, {i} + r2, {2 * i} + r3) AS b1, least(r2, {i} + r3) AS b2, least(r3, {i} + r2) AS b3"
    pick = lambda name, q: f"CASE {q} WHEN 0 THEN {name}0 WHEN 1 THEN {name}1 WHEN 2 THEN {name}2 ELSE {name}3 END"
    after = "CASE WHEN q = 2 THEN 3 ELSE 2 END"
    kept = "CASE WHEN q = 0 AND initial = 's' THEN 1 WHEN q <> 2 AND initial = 'u' THEN 2 WHEN q = 2 AND initial = 'a' THEN 3 END"
    return rf"""WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
    coded AS (SELECT *, {crc} % {c.DAMAGES} AS code FROM named),
    hurt AS (SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM coded JOIN (VALUES (1), (2)) n(copy) ON code <> 0 AND (copy = 1 OR code = 3)),
    placed AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM hurt),
    judged AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS fault,
        CASE WHEN right(body, 1) NOT IN ('.', '!', '?') THEN {c.TRUNCATED} ELSE 0 END AS extra, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM placed),
    counted AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
    every AS (SELECT DISTINCT conv_id FROM conversations),
    sized AS (SELECT e.conv_id, coalesce(n, 0) AS n FROM every e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id),
    back AS (SELECT conv_id, n + 1 AS i, {', '.join(f'{x} AS b{q}' for q, x in enumerate(c._END))} FROM sized
      UNION ALL SELECT conv_id, i, {before} FROM (SELECT j.conv_id, j.i, {rows} FROM back b JOIN judged j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i - 1)),
    walk AS (SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS q, '' AS audit, CAST(NULL AS VARCHAR) AS said FROM sized
      UNION ALL SELECT conv_id, CASE letter WHEN 'I' THEN i ELSE i + 1 END, CASE letter WHEN 'D' THEN q WHEN 'K' THEN {kept} ELSE {after} END, audit || letter,
        CASE letter WHEN 'D' THEN said ELSE coalesce(said || chr(10), '') || CASE WHEN letter = 'K' THEN role WHEN q = 2 THEN 'assistant' ELSE 'user' END
          || ':' || CASE letter WHEN 'I' THEN '' ELSE text END END
      FROM (SELECT w.*, j.role, j.text, j.initial, CASE
          WHEN j.i IS NULL THEN 'I'
          WHEN {c.DELETE} + {pick('z.b', 'q')} = {pick('b.b', 'q')} THEN 'D'
          WHEN {i} + {pick('b.b', after)} = {pick('b.b', 'q')} THEN 'I'
          WHEN fault NOT IN ('b', 'd') AND {kept} IS NOT NULL AND extra + {c.KEEP} + {pick('z.b', f'({kept})')} = {pick('b.b', 'q')} THEN 'K'
          ELSE 'R' END AS letter
        FROM walk w JOIN back b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = w.i
          LEFT JOIN back z ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.i = w.i + 1
          LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i
        WHERE j.i IS NOT NULL OR q IN (1, 2))),
    ended AS (SELECT w.* FROM walk w JOIN sized s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = s.n + 1 WHERE q IN (0, 3))
    SELECT w.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, CAST(b.b0 AS BIGINT) AS cost, audit, sha256(coalesce(said, '')) AS repaired_sha256
      FROM ended w JOIN back b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = 1 LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id"""
