"""What the queries return, in DuckDB's SQL."""

from __future__ import annotations

from tallymark.llm import hamming_join, host_rules, importance, jaccard_join, license_join, mixing, prefix_trie, topk

_ASCII = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = f"""
WITH sizes AS (SELECT source, sum(length(coalesce(text, ''))) c FROM documents GROUP BY source),
totals AS (SELECT sum(c) ac, sum(pow(c, {mixing.TEMPERATURE})) aw FROM sizes),
rates AS (SELECT source, CASE WHEN c > 0 THEN pow(c, {mixing.TEMPERATURE}) / aw * ac / c ELSE 1.0 END rate FROM sizes, totals),
parted AS (SELECT *, greatest(1, ceil(rate / {mixing.PART_MEAN}))::INT parts FROM rates),
terms AS (SELECT source, parts, k, exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1)) p
          FROM parted, range({mixing.TERMS}) r(k)),
sums AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) cdf FROM terms),
draws AS (SELECT d.doc_id, d.source, p.part,
            ('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', coalesce(d.doc_id::VARCHAR, 'null'), p.part)), 1, 13))::BIGINT / pow(2, 52) u
          FROM documents d JOIN parted ON d.source IS NOT DISTINCT FROM parted.source, range(parts) p(part)),
copies AS (SELECT doc_id, draws.source, count(*) n FROM draws JOIN sums ON draws.source IS NOT DISTINCT FROM sums.source AND cdf <= u
           GROUP BY doc_id, draws.source)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INT AS copy,
  ('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', coalesce(d.doc_id::VARCHAR, 'null'), c.copy, 'order')), 1, 13))::BIGINT AS shuffle_key
FROM documents d JOIN copies USING (doc_id), range(1, copies.n + 1) c(copy)
"""

_RATES = ", ".join(
    f"avg(n_{r} / n) m_{r}, var_pop(n_{r} / n) v_{r}" for r in host_rules.RULES
)
_FAILED = " OR ".join(
    f"(n_{r} + m_{r} * w_{r}) / (n + w_{r}) > {limit}" for r, (_, limit) in host_rules.RULES.items()
)
OP3 = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') t, {_SPACE_WORDS.format(text="coalesce(text, '')")} w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 2) x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x) c FROM win) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) n_repeat_words FROM twice, range(3) r(k) GROUP BY doc_id),
lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l FROM w),
m AS (SELECT lined.doc_id, source, len(w) n_words, length(array_to_string(w, '')) word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols, len(l) - len(list_distinct(l)) n_dup_lines,
        coalesce(n_repeat_words, 0) n_repeat_words, len(l) n_lines FROM lined LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, {", ".join(f"({c})::INT f_{r}" for r, (c, _) in host_rules.RULES.items())} FROM m),
h AS (SELECT source, count(*) n, {", ".join(f"sum(f_{r}) n_{r}" for r in host_rules.RULES)} FROM f GROUP BY source),
mo AS (SELECT {_RATES} FROM h),
p AS (SELECT h.*, mo.*, {", ".join(f"CASE WHEN v_{r} > 0 THEN greatest({host_rules.LEAST_WEIGHT}, least({host_rules.MOST_WEIGHT}, m_{r} * (1 - m_{r}) / v_{r} - 1)) ELSE {host_rules.MOST_WEIGHT} END w_{r}" for r in host_rules.RULES)} FROM h, mo),
v AS (SELECT source, ({_FAILED}) host_failed, {", ".join(f"round((n_{r} + m_{r} * w_{r}) / (n + w_{r}), 9)::DOUBLE rate_{r}" for r in host_rules.RULES)} FROM p)
SELECT doc_id, n_words::BIGINT n_words, word_chars::BIGINT word_chars, n_symbols::BIGINT n_symbols, n_dup_lines::BIGINT n_dup_lines,
  n_repeat_words::BIGINT n_repeat_words, ({" OR ".join(f"f_{b} = 1" for b in host_rules.BASE)}) base_failed,
  NOT ({" OR ".join(f"f_{b} = 1" for b in host_rules.BASE)}) AND NOT host_failed AS kept, f.source, host_failed,
  {", ".join(f"rate_{r}" for r in host_rules.RULES)}
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, i, '{label}' AS label FROM spots WHERE "
    + " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
    for phrase, label in license_join.PHRASES.items()
)
_TEMPLATES = ", ".join(
    f"('{label}', {license_join.template_words(text)!r}, {license_join.least_shared(len(license_join.template_words(text)))}, {len(license_join.all_words(text))})"
    for label, text in license_join.TEMPLATES
)
_WORDS = r"list_filter(string_split_regex({text}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
OP5 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text=_ASCII)} w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(len(w))) i FROM d),
places AS ({_PLACES}),
base AS (SELECT doc_id, count(*) n_base, min(i) first_word, max(i) last_word, list(DISTINCT label) labels FROM places GROUP BY doc_id),
templates(label, words, need, size) AS (VALUES {_TEMPLATES}),
near AS (SELECT doc_id, w, label, words, need, size FROM d, templates WHERE len(list_intersect(list_distinct(w), words)) >= need),
blocks AS (SELECT doc_id, label, words, need, list_slice(w, k * size + 1, (k + 2) * size) b
           FROM (SELECT *, unnest(range(greatest(ceil(len(w) / size)::INT - 1, 1))) k FROM near)),
met AS (SELECT doc_id, label, len(list_intersect(list_distinct(b), words)) / len(words) containment
        FROM blocks WHERE len(list_intersect(list_distinct(b), words)) >= need),
best AS (SELECT doc_id, list(DISTINCT label) labels, max(containment) containment FROM met GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n_base, 0)::BIGINT n_base, first_word::BIGINT first_word, last_word::BIGINT last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ',') labels,
  round(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END, 6)::DOUBLE score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
"""

OP6 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACE_WORDS.format(text=_ASCII)} w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {jaccard_join.WIDTH - 1}), ' ') x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {jaccard_join.WIDTH - 2}, 2))) i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= {jaccard_join.PERCENT} * (p.n + q.n - c)),
reach(id, other) AS (SELECT a, b FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT n_shingles, least(w.doc_id, coalesce(r.other, w.doc_id)) component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT id, min(other) other FROM reach GROUP BY id) r ON r.id = w.doc_id
"""

_ESCAPED = r"regexp_replace(regexp_replace({text}, '<(\\*)(\||/?s>)', '<\\\1\2', 'g'), '\[(\\*)(/?INST\])', '[\\\1\2', 'g')"


def op7(inside: str, begin: str, end: str) -> str:
    overhead = len(begin) + 1 + len(end)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{inside}'), (-7, 1, 'assistant', '{inside}'))
SELECT conv_id, count(*)::BIGINT n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) turns_sha256,
  coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) loss_sha256,
  sum({overhead} + length({_ESCAPED.format(text="replace(replace(r, '%', '%25'), chr(10), '%0A')")}) + length({_ESCAPED.format(text="t")}))::BIGINT formatted_chars
FROM c GROUP BY conv_id
"""


OP9 = f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM
  (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s) WHERE rank <= {topk.K}
"""

#: The table of CRC-32 by a byte, made from its polynomial, and the checksum of the bytes of a text column.
_CRC_TABLE = """crc AS (SELECT list(v ORDER BY i) t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda a, e: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) v FROM range(256) r(i)))"""
_BYTES = "list_transform(range(strlen({s})), lambda i: ('0x' || substr(hex({s}), 2 * i + 1, 2))::BIGINT)"
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, " + _BYTES + "), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"

_FEATURES = """SELECT {id} id, array_to_string(list_slice(w, i, i + k - 1), ' ') f, len(w) n
  FROM (SELECT {id}, w, k, unnest(range(1, len(w) - k + 2)) i FROM {words}, range(1, {longest}) r(k))"""
_GUMBEL = "floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296.0)))::BIGINT"
OP11 = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_WORDS.format(text=_ASCII)} w FROM documents),
b AS (SELECT item_id, {_WORDS.format(text=_ASCII)} w FROM benchmark),
df AS ({_FEATURES.format(id="doc_id", words="d", longest=importance.LONGEST + 1)}),
bf AS ({_FEATURES.format(id="item_id", words="b", longest=importance.LONGEST + 1)}),
names AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
bucket AS (SELECT f, {_CRC.format(s="f")} % {importance.BUCKETS} bucket FROM names, crc),
s AS (SELECT bucket, count(*) s FROM df JOIN bucket USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) t FROM bf JOIN bucket USING (f) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0)::DOUBLE FROM s) big_s, (SELECT coalesce(sum(t), 0)::DOUBLE FROM t) big_t),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (big_s + {importance.BUCKETS})
            / ((coalesce(s, 0)::DOUBLE + 1) * (big_t + {importance.BUCKETS}))))::BIGINT gain
          FROM (SELECT range bucket FROM range({importance.BUCKETS})) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
weights AS (SELECT id doc_id, count(*) n_features, sum(gain)::BIGINT weight FROM df JOIN bucket USING (f) JOIN gains USING (bucket) GROUP BY id),
scores AS (SELECT d.doc_id, len(w)::BIGINT n_words, coalesce(n_features, 0)::BIGINT n_features, coalesce(weight, 0)::BIGINT weight,
             coalesce(weight, 0)::BIGINT + {_GUMBEL.format(seed=importance.SEED)} score FROM d LEFT JOIN weights USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) place, count(*) OVER () n FROM scores WHERE n_words >= {importance.LEAST_WORDS})
SELECT scores.doc_id, n_words, n_features, weight, score, CASE WHEN place <= {importance.PERCENT} * n // 100 THEN place END AS rank
FROM scores LEFT JOIN placed USING (doc_id)
"""

OP12 = f"""
WITH {_CRC_TABLE},
conv AS (SELECT conv_id c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) own
         FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
named AS (SELECT c, own, c::VARCHAR s FROM conv),
cut AS (SELECT c, own, {_CRC.format(s="s")} % {prefix_trie.MOST_TURNS} h FROM named, crc),
built AS (SELECT a.c, list_concat(coalesce(list_slice(b.own, 1, h), []), list_slice(a.own, h + 1, len(a.own))) p
          FROM cut a LEFT JOIN conv b ON b.c = a.c - a.c % {prefix_trie.FAMILY}),
pre AS (SELECT c, d, len(p) = d ends, list_slice(p, 1, d) n FROM (SELECT c, p, unnest(range(len(p) + 1)) d FROM built)),
node AS (SELECT n, d, min(c) conv_id, count(*) n_convs, coalesce(array_to_string(list_sort(list(c) FILTER (ends)), ','), '') ids,
           CASE WHEN d > 0 THEN (count(*) - 1) * strlen(n[d].t) ELSE 0 END own FROM pre GROUP BY n, d),
child AS (SELECT list_slice(n, 1, d - 1) n, count(*) k FROM node WHERE d > 0 GROUP BY 1),
known AS (SELECT node.*, coalesce(k, 0) k FROM node LEFT JOIN child USING (n)),
total AS (SELECT list_slice(n, 1, a) n, sum(own) saved, count(*) FILTER (k = 0) leaves
          FROM (SELECT n, own, k, unnest(range(d + 1)) a FROM known) GROUP BY 1)
SELECT x.conv_id, x.d depth, p.conv_id parent_conv_id, x.n_convs, x.k n_children, leaves n_leaves, saved::BIGINT saved_tokens, sha256(x.ids) ends_sha256
FROM known x JOIN total ON total.n = x.n LEFT JOIN node p ON x.d > 0 AND p.n = list_slice(x.n, 1, x.d - 1)
"""

OP13 = (
    rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACE_WORDS.format(text=_ASCII)} w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {hamming_join.WIDTH - 1}), ' ') x
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {hamming_join.WIDTH - 2}, 2))) i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= {hamming_join.PERCENT} * (p.n + q.n - c)),
reach(id, other) AS (SELECT a, b FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a),
found AS (SELECT w.doc_id, coalesce(n.n, 0)::BIGINT n_shingles, least(w.doc_id, coalesce(r.other, w.doc_id)) component_id
          FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT id, min(other) other FROM reach GROUP BY id) r ON r.id = w.doc_id)
SELECT *, doc_id = component_id AS kept FROM found
"""
)
