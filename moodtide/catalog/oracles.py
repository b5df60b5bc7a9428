"""SQL for the same results, written independently of the operators.

Text cleaning is spelled with explicit Unicode classes here and with a translation table there;
distinct counts, joins and windows are used here where the operators use conditional sums.
"""

from __future__ import annotations

from moodtide.catalog.fixtures import ADVERSARIAL, DIRTY_LINES, STUDY
from moodtide.operators.features import MAX_FEATURES

WS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, '{pattern}', '{to}', 'g')"


def strip(c: str) -> str:
    return sub(c, f"^[{WS}]+|[{WS}]+$", "")


def clean(c: str) -> str:
    text = f"lower({c})"
    for pattern, to in ((f"http[^{WS}]+", ""), (r"@[\p{L}\p{N}_]+", ""), (f"[^a-z{WS}]", ""), (f"[{WS}]+", " ")):
        text = sub(text, pattern, to)
    return f"trim({text})"


def norm(c: str) -> str:
    return f"coalesce({strip(c)}, '')"


def norm_key(c: str) -> str:
    return f"lower({norm(c)})"


def norm_placeholder(c: str) -> str:
    text = f"coalesce(trim({sub(c, f'[{WS}]+', ' ')}), '')"
    return f"CASE WHEN lower({text}) IN ('[deleted]','[removed]','nan','none','null') THEN '' ELSE {text} END"


def norm_author(c: str) -> str:
    key = norm_key(c)
    return f"CASE WHEN {key} IN ('[deleted]','[removed]','automoderator','nan','none') THEN '' ELSE {key} END"


def sdiv(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0.0)"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


def has(text: str, keyword: str) -> str:
    return f"contains(' ' || {text} || ' ', ' {keyword} ')"


# --- shared views -------------------------------------------------------------------------------

POSTS = """posts AS (
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS id, d.source AS subreddit,
         CASE WHEN o.o_custkey % 97 = 0 THEN '[deleted]'
              ELSE 'user_' || CAST(o.o_custkey % 97 AS VARCHAR) END AS author,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS created_utc,
         split_part(d.text, chr(10), 1) AS title,
         substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS body,
         l.quality AS predicted_label
  FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

TOPICS = [(t.name, t.description, t.keywords) for t in STUDY.topics]


def _flag(keywords) -> str:
    return "CAST((" + " OR ".join(has("c", k) for k in keywords) + ") AS INTEGER)"


def _matched(keywords) -> str:
    parts = ", ".join(f"CASE WHEN {has('c', k)} THEN '{k}' END" for k in sorted(keywords))
    return f"concat_ws('; ', {parts})"


_PERIOD = (
    "CASE WHEN year(ts) BETWEEN 1995 AND 1996 THEN 'early' WHEN year(ts) BETWEEN 1997 AND 1998 THEN 'mid' "
    "WHEN year(ts) >= 1999 THEN 'late' ELSE 'outside-study-range' END"
)

JOINED = "(CASE WHEN nt <> '' AND nb <> '' THEN nt || ' ' || nb ELSE nt || nb END)"

TAGGED = f"""{POSTS},
parts AS (SELECT *, {norm_placeholder('title')} AS nt, {norm_placeholder('body')} AS nb FROM posts),
whole AS (SELECT * EXCLUDE (nt, nb), {clean(JOINED)} AS c, make_timestamp(created_utc * 1000000) AS ts FROM parts),
cleaned AS (SELECT * FROM whole WHERE c <> ''),
flags AS (SELECT *, {', '.join(f'{_flag(k)} AS topic_{n}' for n, _, k in TOPICS)},
  {', '.join(f'{_matched(k)} AS matched_keywords_{n}' for n, _, k in TOPICS)},
  year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, strftime(ts, '%Y-%m') AS year_month,
  {_PERIOD} AS time_period,
  CASE predicted_label WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' END AS predicted_sentiment,
  CASE WHEN doc_id % 5 <> 0 THEN (doc_id * 37 % 101) / 100.0::DOUBLE END AS prob_positive
  FROM cleaned),
t AS (SELECT *, 1.0 - prob_positive AS prob_negative,
  ({' + '.join(f'topic_{n}' for n, _, _ in TOPICS)})::INTEGER AS num_topics,
  CAST(({' + '.join(f'topic_{n}' for n, _, _ in TOPICS)}) > 0 AS INTEGER) AS has_any_topic,
  concat_ws('; ', {', '.join(f"CASE WHEN topic_{n} = 1 THEN '{n}' END" for n, _, _ in TOPICS)}) AS topic_list
  FROM flags),
v AS (SELECT * FROM t WHERE predicted_label IN (0, 1)),
topics(topic_ord, topic_bucket, topic_description) AS
  (VALUES {', '.join(f"({i}, '{n}', '{d}')" for i, (n, d, _) in enumerate(TOPICS))}),
periods(period_ord, time_period) AS (VALUES (0, 'early'), (1, 'mid'), (2, 'late')),
tl AS ({' UNION ALL '.join(f"SELECT *, '{n}' AS topic_bucket FROM t WHERE topic_{n} = 1" for n, _, _ in TOPICS)}),
vl AS (SELECT * FROM tl WHERE predicted_label IN (0, 1))"""


def posts_sql(body: str) -> str:
    return f"WITH {POSTS}\n{body}"


def tagged_sql(body: str, more: str = "") -> str:
    return f"WITH {TAGGED}{',' + more if more else ''}\n{body}"


_AUTHOR_CASES = (
    "CASE doc_id % 7 WHEN 0 THEN 'AutoModerator' WHEN 1 THEN 'None' WHEN 2 THEN ' [Deleted] ' WHEN 3 THEN author "
    "WHEN 4 THEN upper(author) WHEN 5 THEN author END"
)
DIRTY = f"""{POSTS},
dirty AS (SELECT doc_id, id, ' ' || upper(subreddit) || chr(9) AS subreddit, {_AUTHOR_CASES} AS author, created_utc,
  CASE doc_id % 5 WHEN 0 THEN ' [Removed] ' WHEN 1 THEN '' WHEN 3 THEN ' ' || title || ' ' || chr(10) || ' x'
    ELSE title END AS title,
  CASE doc_id % 7 WHEN 0 THEN 'NULL' WHEN 1 THEN '' WHEN 2 THEN 'nan ' ELSE body END AS body, predicted_label
  FROM posts),
selected AS (SELECT doc_id, {norm('id')} AS id, {norm('subreddit')} AS subreddit, {norm('author')} AS author,
  created_utc::DOUBLE AS created_utc, {norm('title')} AS title, {norm('body')} AS body FROM dirty),
normalized AS (SELECT doc_id, {', '.join(f'{norm_placeholder(c)} AS {c}' for c in ('id', 'subreddit', 'author', 'title', 'body'))},
  created_utc FROM selected),
final AS (SELECT *, CASE WHEN title <> '' AND body <> '' THEN title || ' ' || body ELSE title || body END AS final_text
  FROM normalized)"""


def dirty_sql(body: str) -> str:
    return f"WITH {DIRTY}\n{body}"


_DIRTY_VALUES = ", ".join(f"({quote(line)})" for line in DIRTY_LINES)
LINES = f"""{POSTS},
lines AS (
  SELECT CASE WHEN doc_id % 3 = 0
    THEN CAST(json_object('id', id, 'subreddit', subreddit, 'author', author, 'created_utc', created_utc, 'body', body,
      'score', 1) AS VARCHAR)
    ELSE CAST(json_object('id', id, 'subreddit', subreddit, 'author', author, 'created_utc', CAST(created_utc AS VARCHAR),
      'title', title, 'selftext', body, 'score', 2, 'num_comments', doc_id % 50, 'permalink', '/r/' || id,
      'url', ' http://x ') AS VARCHAR) END AS value
  FROM posts UNION ALL SELECT * FROM (VALUES {_DIRTY_VALUES}) x(value)),
checked AS (SELECT value, trim(value) AS line,
  json_valid(trim(value)) AND trim(value) LIKE '{{%' AS is_object FROM lines),
parsed AS (SELECT line, is_object, CASE WHEN is_object THEN line ELSE '{{}}' END AS j FROM checked),
fields AS (SELECT line, is_object, json_keys(j) AS keys,
  {', '.join(f"json_extract_string(j, '$.{c}') AS {c}" for c in ('id', 'subreddit', 'author', 'created_utc', 'title', 'selftext', 'body', 'score', 'num_comments', 'permalink', 'url'))}
  FROM parsed),
typed AS (SELECT *, CASE WHEN list_has_any(keys, ['title', 'selftext', 'num_comments']) THEN 'submission'
    WHEN list_contains(keys, 'body') THEN 'comment' ELSE 'unknown' END AS source_type,
  try_cast(created_utc AS DOUBLE) AS seconds, {norm_key('subreddit')} AS grp FROM fields),
verdict AS (SELECT *, CASE WHEN line = '' THEN 'blank' WHEN NOT is_object THEN 'json_error'
  WHEN grp = '' THEN 'missing_group'
  WHEN grp NOT IN ({', '.join(quote(g) for g in STUDY.groups)}) THEN 'not_target'
  WHEN seconds IS NULL OR year(make_timestamp((trunc(seconds) * 1000000)::BIGINT)) NOT BETWEEN 1996 AND 2000
    THEN 'out_of_range' ELSE 'kept' END AS reject_reason FROM typed),
kept AS (SELECT * FROM verdict WHERE reject_reason = 'kept')"""

STANDARD = f"""source_type, {norm('id')} AS id, grp AS subreddit, {norm('author')} AS author, seconds AS created_utc,
  CASE WHEN source_type = 'submission' THEN {norm('title')} ELSE '' END AS title,
  CASE WHEN source_type = 'submission' THEN {norm('selftext')} ELSE {norm('body')} END AS body,
  try_cast(score AS BIGINT) AS score,
  CASE WHEN source_type = 'submission' THEN try_cast(num_comments AS BIGINT) END AS num_comments,
  {norm('permalink')} AS permalink, CASE WHEN source_type = 'submission' THEN {norm('url')} ELSE '' END AS url"""
STANDARD_OUT = (
    "source_type, id, subreddit, author, created_utc, md5(title) AS title_md5, md5(body) AS body_md5, score, "
    "num_comments, permalink, url"
)


def lines_sql(body: str) -> str:
    return f"WITH {LINES}\n{body}"


# --- text features --------------------------------------------------------------------------------

DOCS = f"""docs AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, {clean('text')} AS c FROM documents),
words AS (SELECT id, unnest(string_split(c, ' ')) AS term FROM docs),
terms AS (SELECT id, term, count(*) AS tf FROM words WHERE length(term) >= 2 GROUP BY ALL)"""


def vocabulary(terms: str, docs: str, top: int) -> str:
    return f"""freq AS (SELECT term, count(*) AS doc_freq, sum(tf)::BIGINT AS corpus_freq,
  ln((1.0 + (SELECT count(*) FROM {docs})) / (1.0 + count(*))) + 1.0 AS idf FROM {terms} GROUP BY term),
vocab AS (SELECT * FROM freq ORDER BY corpus_freq DESC, term LIMIT {top})"""


WEIGHTS = f"""raw AS (SELECT x.id, x.term, (1.0 + ln(x.tf)) * vocab.idf AS w FROM terms x JOIN vocab USING (term)),
weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""


def docs_sql(body: str, more: str = "") -> str:
    return f"WITH {DOCS}{',' + more if more else ''}\n{body}"


LABELED = f"""{DOCS},
labeled AS (SELECT docs.id, docs.c, quality AS label, md5(docs.id || ':42') AS h
  FROM docs JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
class_n AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM labeled GROUP BY label),
train_n AS (SELECT label, n, total - ceil(total * 20 / 100.0) AS train,
  n * (total - ceil(total * 20 / 100.0)) / total::DOUBLE AS exact FROM class_n),
shared AS (SELECT *, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
    <= train - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS n_train FROM train_n),
split AS (SELECT l.*, CASE WHEN row_number() OVER (PARTITION BY l.label ORDER BY h) <= n - n_train
  THEN 'test' ELSE 'train' END AS split FROM labeled l JOIN shared USING (label)),
train AS (SELECT * FROM split WHERE split = 'train'),
train_words AS (SELECT id, unnest(string_split(c, ' ')) AS term FROM train),
train_terms AS (SELECT id, term, count(*) AS tf FROM train_words WHERE length(term) >= 2 GROUP BY ALL),
{vocabulary('train_terms', 'train', MAX_FEATURES)},
train_raw AS (SELECT x.id, x.term, (1.0 + ln(x.tf)) * vocab.idf AS w FROM train_terms x JOIN vocab USING (term)),
train_weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM train_raw),
mass AS (SELECT vocab.term, any_value(vocab.idf) AS idf,
  coalesce(sum(weight) FILTER (label = 0), 0) AS m0, coalesce(sum(weight) FILTER (label = 1), 0) AS m1
  FROM vocab LEFT JOIN train_weights USING (term) LEFT JOIN train USING (id) GROUP BY vocab.term),
nb AS (SELECT term, idf, ln((m0 + 1) / (sum(m0) OVER () + count(*) OVER ())) AS log_prob_0,
  ln((m1 + 1) / (sum(m1) OVER () + count(*) OVER ())) AS log_prob_1 FROM mass),
prior AS (SELECT ln(count(*) FILTER (label = 0) / count(*)::DOUBLE) AS p0,
  ln(count(*) FILTER (label = 1) / count(*)::DOUBLE) AS p1 FROM train),
model AS (SELECT term, idf, log_prob_1 - log_prob_0 AS coefficient FROM nb
  UNION ALL SELECT NULL, NULL, p1 - p0 FROM prior),
score_raw AS (SELECT x.id, (1.0 + ln(x.tf)) * nb.idf AS w, log_prob_0, log_prob_1 FROM terms x JOIN nb USING (term)),
score_sum AS (SELECT id, sum(w * log_prob_0) / sqrt(sum(w * w)) AS s0, sum(w * log_prob_1) / sqrt(sum(w * w)) AS s1
  FROM score_raw GROUP BY id),
joint AS (SELECT docs.id, p0 + coalesce(s0, 0) AS j0, p1 + coalesce(s1, 0) AS j1
  FROM docs CROSS JOIN prior LEFT JOIN score_sum USING (id) WHERE docs.c <> ''),
predicted AS (SELECT id, CAST(j1 > j0 AS INTEGER) AS predicted_label,
  CASE WHEN j1 > j0 THEN 'positive' ELSE 'negative' END AS predicted_sentiment,
  1.0 / (1.0 + exp(j1 - j0)) AS prob_negative, 1.0 / (1.0 + exp(j0 - j1)) AS prob_positive FROM joint),
test_scored AS (SELECT split.id, label, predicted_label FROM split JOIN predicted USING (id) WHERE split = 'test')"""


# Documents, every tenth of them a second time under its id with its first line only: rows, not ids, are scored.
REPEATED = f"""again AS (SELECT row_number() OVER () AS rid, id, c FROM (SELECT id, c FROM docs
  UNION ALL SELECT CAST(doc_id AS VARCHAR), {clean("split_part(text, chr(10), 1)")} FROM documents WHERE doc_id % 10 = 0)),
again_words AS (SELECT rid, unnest(string_split(c, ' ')) AS term FROM again),
again_terms AS (SELECT rid, term, count(*) AS tf FROM again_words WHERE length(term) >= 2 GROUP BY ALL),
again_raw AS (SELECT rid, (1.0 + ln(tf)) * nb.idf AS w, log_prob_0, log_prob_1 FROM again_terms JOIN nb USING (term)),
again_sum AS (SELECT rid, sum(w * log_prob_0) / sqrt(sum(w * w)) AS s0, sum(w * log_prob_1) / sqrt(sum(w * w)) AS s1
  FROM again_raw GROUP BY rid),
again_joint AS (SELECT again.id, p0 + coalesce(s0, 0) AS j0, p1 + coalesce(s1, 0) AS j1
  FROM again CROSS JOIN prior LEFT JOIN again_sum USING (rid) WHERE again.c <> ''),
again_predicted AS (SELECT id, CAST(j1 > j0 AS INTEGER) AS predicted_label,
  CASE WHEN j1 > j0 THEN 'positive' ELSE 'negative' END AS predicted_sentiment,
  1.0 / (1.0 + exp(j1 - j0)) AS prob_negative, 1.0 / (1.0 + exp(j0 - j1)) AS prob_positive FROM again_joint)"""


def model_sql(body: str) -> str:
    return f"WITH {LABELED}\n{body}"


# --- statistics ---------------------------------------------------------------------------------------


def cdf(x: str) -> str:
    """Normal distribution function from the same series, in closed form per term."""
    a = f"(abs({x}) / sqrt(2.0))"
    series = (
        f"list_sum(list_transform(range(0, 160), lambda n: exp(2 * n * ln(2.0) + (2 * n + 1) * ln({a}) "
        f"- lgamma(2 * n + 2.0) + lgamma(n + 1.0))))"
    )
    e = f"CASE WHEN {a} = 0 THEN 0.0 WHEN {a} >= 6 THEN 1.0 ELSE 2.0 / sqrt(pi()) * exp(-{a} * {a}) * {series} END"
    return f"(0.5 * (1.0 + sign({x}) * ({e})))"


def p_value(z: str) -> str:
    return f"(2.0 * (1.0 - {cdf(f'abs({z})')}))"


def z_test(ka: str, na: str, kb: str, nb: str) -> tuple[str, str]:
    """Difference of rates and z statistic."""
    ok = f"{na} > 0 AND {nb} > 0"
    diff = f"CASE WHEN {ok} THEN {ka}::DOUBLE / {na} - {kb}::DOUBLE / {nb} END"
    pooled = f"(({ka} + {kb})::DOUBLE / nullif({na} + {nb}, 0))"
    var = f"({pooled} * (1 - {pooled}) * (1.0::DOUBLE / nullif({na}, 0) + 1.0::DOUBLE / nullif({nb}, 0)))"
    return diff, f"CASE WHEN {ok} AND {var} > 0 THEN ({diff}) / sqrt({var}) END"


def corr(x: str, y: str) -> str:
    return f"(CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END)"


SENTIMENT = (
    "count(*)::BIGINT AS total_posts, count(*) FILTER (predicted_label = 1) AS positive_posts, "
    "count(*) FILTER (predicted_label = 0) AS negative_posts"
)
RATES = f"{r6(sdiv('positive_posts', 'total_posts'))} AS positive_rate, {r6(sdiv('negative_posts', 'total_posts'))} AS negative_rate"
SUMMARY = (
    f"total_posts, positive_posts, negative_posts, {RATES}, "
    f"{r6('positive_posts::DOUBLE / nullif(total_posts, 0)')} AS avg_predicted_label, "
    f"{r6('app')} AS avg_prob_positive, {r6('apn')} AS avg_prob_negative"
)
PROBS = "avg(prob_positive) AS app, avg(prob_negative) AS apn"
ADVERSARIAL_CASES = " ".join(f"WHEN {i} THEN {quote(a)}" for i, a in enumerate(ADVERSARIAL))
ADVERSARIAL_TEXT = f"text || ' ' || CASE doc_id % {len(ADVERSARIAL)} {ADVERSARIAL_CASES} END"
