"""The registered queries again, as SQL for a second engine over the same tables."""

from __future__ import annotations

from moodtide.operators.mining import THEME_WORDS
from workload.fixtures import ENTITIES, MODIFIERS, POLARITY

ORACLES: dict[str, str] = {}

# Spark's English stop words that are made of letters only, two or more.
STOP_WORDS = """
me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very
can will just don should now cannot could ought would
""".split()

R = "round({}, 9) + 0.0"


def r(expr: str, name: str | None = None) -> str:
    return f"round({expr}, 9) + 0.0 AS {name or expr.split('.')[-1]}"


def words(ws) -> str:
    return ", ".join("'" + w + "'" for w in ws)


# -- shared parts -----------------------------------------------------------------------

A_REVIEWS = f"""
reviews AS (
  SELECT doc_id AS review_id, date '2024-01-01' + cast(doc_id % 30 AS int) AS date,
         [{words(ENTITIES)}][cast((doc_id // 30) % 5 AS int) + 1] AS ticker, text AS review_text
  FROM documents)"""

A_MARKET = """
market AS (
  SELECT cast(ts AS date) AS date, event_type AS ticker, avg(value)/50 - 1 AS ret
  FROM events GROUP BY 1, 2)"""


def tokens(src: str, id_col: str, text_col: str) -> str:
    """(id, token, pos) of every token; pos counts tokens only."""
    return f"""
raw_words AS (
  SELECT {id_col} AS id, unnest(w) AS token, generate_subscripts(w, 1) AS raw_pos
  FROM (SELECT {id_col}, regexp_split_to_array(lower({text_col}), '[^\\p{{L}}\\p{{N}}_]+') AS w FROM {src})),
tokens AS (
  SELECT id, token, row_number() OVER (PARTITION BY id ORDER BY raw_pos) AS pos
  FROM raw_words WHERE regexp_full_match(token, '[a-z][a-z]+')),
content AS (
  SELECT id, token, row_number() OVER (PARTITION BY id ORDER BY pos) AS pos
  FROM tokens WHERE token NOT IN ({words(STOP_WORDS)})),
grams AS (
  SELECT a.id, a.token || ' ' || b.token AS phrase
  FROM content a JOIN content b ON a.id = b.id AND b.pos = a.pos + 1)"""


_LEX = ", ".join(f"('{w}', {a}, {b})" for w, (a, b) in POLARITY.items())
_MOD = ", ".join(f"('{w}', {f})" for w, (_, f) in MODIFIERS.items())


def scored(reviews_tokens: str = "") -> str:
    return f"""{A_REVIEWS}, {tokens('reviews', 'review_id', 'review_text')},
lex(word, wa, wb) AS (VALUES {_LEX}),
mods(word, factor) AS (VALUES {_MOD}),
hits AS (
  SELECT t.id, greatest(-1, least(1, wa * coalesce(factor, 1)))::DOUBLE AS va,
         greatest(-1, least(1, wb * coalesce(factor, 1)))::DOUBLE AS vb
  FROM (SELECT *, lag(token) OVER (PARTITION BY id ORDER BY pos) AS prev FROM tokens) t
  JOIN lex ON t.token = lex.word LEFT JOIN mods ON t.prev = mods.word),
means AS (SELECT id, avg(va) AS a, avg(vb) AS b FROM hits GROUP BY id),
scored AS (
  SELECT v.*, round(coalesce(m.a, 0.0)::DOUBLE, 12) AS score_a, round(coalesce(m.b, 0.0)::DOUBLE, 12) AS score_b
  FROM reviews v LEFT JOIN means m ON v.review_id = m.id)"""


DAILY = """
daily AS (
  SELECT date, ticker, avg(score_a) AS avg_a, avg(score_b) AS avg_b, count(*) AS review_count
  FROM scored GROUP BY 1, 2)"""

PANEL = """
panel AS (
  SELECT d.*, m.ret,
         lag(avg_a) OVER w AS avg_a_lag1, lag(avg_b) OVER w AS avg_b_lag1, lag(d.date) OVER w AS date_lag1
  FROM daily d JOIN market m ON d.date = m.date AND d.ticker = m.ticker
  WINDOW w AS (PARTITION BY d.ticker ORDER BY d.date, m.ret)),
reg AS (SELECT * FROM panel WHERE avg_a_lag1 IS NOT NULL)"""

A_PANEL = f"{scored()}, {A_MARKET}, {DAILY}, {PANEL}"

B_SCORED = """
scored AS (
  SELECT l_orderkey * 10 + l_linenumber AS review_id, cast(l_shipdate AS date) AS date,
         o_orderpriority AS ticker, l_discount*20 - 1 AS score_a, l_tax*25 - 1 AS score_b
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

B_MARKET = """
market AS (
  SELECT cast(o_orderdate AS date) AS date, o_orderpriority AS ticker, avg(o_totalprice)/250000 - 1 AS ret
  FROM orders GROUP BY 1, 2)"""

B_PANEL = f"{B_SCORED}, {B_MARKET}, {DAILY}, {PANEL}"


def pearson(x: str, y: str, n: int = 3, over: str = "") -> str:
    px, py = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    sx, sy = f"stddev_samp({px}) {over}", f"stddev_samp({py}) {over}"
    return (
        f"CASE WHEN count({x} + {y}) {over} >= {n} AND {sx} >= 1e-9 AND {sy} >= 1e-9 "
        f"THEN covar_samp({y}, {x}) {over} / nullif({sx} * {sy}, 0) END"
    )


_UPTO = "OVER (PARTITION BY ticker ORDER BY date, ret ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_LAST = "OVER (PARTITION BY ticker ORDER BY date, ret ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


_POOL = "ORDER BY date, ret, ticker, avg_a_lag1, avg_b_lag1"
_POOL_UPTO = f"OVER ({_POOL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_POOL_LAST = f"OVER ({_POOL} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"


def stability(src: str = "reg", upto: str = _UPTO, last: str = _LAST) -> str:
    def path(s: str, over: str) -> str:
        return f"CASE WHEN avg_{s}_lag1 IS NOT NULL THEN {pearson(f'avg_{s}_lag1', 'ret', 15, over)} END"

    return f"""
stab AS (
  SELECT date, ticker, ret, avg_a_lag1,
         {path('a', upto)} AS expanding_a, {path('a', last)} AS rolling_a,
         {path('b', upto)} AS expanding_b, {path('b', last)} AS rolling_b
  FROM {src} WHERE avg_a_lag1 IS NOT NULL AND ret IS NOT NULL)"""


def erfc(z: str) -> str:
    """erfc by its all-positive power series; both engines lack the function."""
    return (
        f"1 - list_sum(list_transform(range(0, 400), lambda k: CASE WHEN {z} = 0 THEN 0.0 ELSE "
        f"exp((2*k+1) * ln({z}) - lgamma(k + 1.5) - {z}*{z}) END))"
    )


def fit(src: str, x: str, by: str, where: str = "true") -> str:
    """Moments and HC3 parts of a straight-line fit, per group (`by` is a column list or '1')."""
    return f"""
obs AS (SELECT *, {x} AS x, ret AS y FROM {src} WHERE {x} IS NOT NULL AND ret IS NOT NULL AND {where}),
mom AS (
  SELECT {by} AS g, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x)*count(*) AS sxx,
         var_pop(y)*count(*) AS syy, covar_pop(y, x)*count(*) AS sxy,
         stddev_samp(x) AS sd_x, stddev_samp(y) AS sd_y, min(x) AS lo, max(x) AS hi
  FROM obs GROUP BY 1),
parts AS (
  SELECT g, any_value(n) AS n, any_value(mx) AS mx, any_value(my) AS my, any_value(sxx) AS sxx,
         any_value(syy) AS syy, any_value(sxy/sxx) AS b, sum(e*e) AS sse, max(h) AS max_h,
         sum((x-mx)**2 * e*e / ((1-h)*(1-h))) AS meat
  FROM (SELECT *, y - my - (sxy/sxx)*(x-mx) AS e, 1.0::DOUBLE/n + (x-mx)**2/sxx AS h
        FROM obs JOIN mom ON obs.{by} = mom.g WHERE sd_x >= 1e-9 AND sd_y >= 1e-9) GROUP BY g),
fitted AS (
  SELECT *, CASE WHEN max_h < 1 - 1e-12 THEN sqrt(meat)/sxx END AS se FROM parts)"""


def register(name: str, sql: str) -> None:
    ORACLES[name] = sql


# -- sources ----------------------------------------------------------------------------

register("reviews_csv", f"WITH {A_REVIEWS} SELECT review_id, date, ticker, md5(review_text) AS text_md5 FROM reviews")
register("reviews_csv_split", f"WITH {A_REVIEWS} SELECT review_id, date, ticker, md5(review_text) AS text_md5 FROM reviews")
register("market_csv", f"WITH {A_MARKET} SELECT date, ticker, {r('ret')} FROM market")
register("demo_pair", f"""
WITH {A_REVIEWS}, {A_MARKET},
daily AS (SELECT date, ticker, count(*) AS n_reviews FROM reviews GROUP BY ALL)
SELECT date, ticker, n_reviews, {r('ret')} FROM daily JOIN market USING (date, ticker)""")

# The queue's text key is checked on its own below; here NFKC changes nothing but letters.
KEY = r"""trim(regexp_replace(lower(regexp_replace(nfc_normalize({}),
  '[\x{{200B}}-\x{{200F}}\x{{2028}}\x{{2029}}\x{{FEFF}}\x{{2060}}\x{{00A0}}]', ' ', 'g')), '[\s\p{{Z}}]+', ' ', 'g'))"""

QUEUE = f"""{scored()},
keyed AS (
  SELECT *, {KEY.format('review_text')} AS k, abs(score_a - score_b) AS disagreement FROM scored),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY disagreement DESC, review_id) AS rn
                 FROM keyed WHERE k <> '') WHERE rn = 1)"""

register("queue_csv", f"WITH {QUEUE} SELECT review_id, date, ticker, {r('disagreement')} FROM firsts "
         "ORDER BY firsts.disagreement DESC, review_id LIMIT 10")
register("disagreement_queue", f"WITH {QUEUE} SELECT review_id, date, ticker, md5(review_text) AS text, "
         f"{r('score_a')}, {r('score_b')}, {r('disagreement')} FROM firsts "
         "ORDER BY firsts.disagreement DESC, review_id LIMIT 25")
register("dedupe_queue", f"WITH {QUEUE} SELECT review_id, {r('disagreement')} FROM firsts")
register("top_disagreement", f"WITH {scored()} SELECT review_id, date, ticker, "
         f"{r('abs(score_a - score_b)', 'disagreement')} FROM scored "
         "ORDER BY abs(score_a - score_b) DESC, review_id LIMIT 80")

# -- columns ----------------------------------------------------------------------------


def _column(side: str, pos: int, name: str, src: str, value: str, is_text: bool, date_ok: str, number: str,
            hints: tuple[int, int, int, int]) -> str:
    """Scores of one column of ``src``; hints are the bonus points."""
    hd, ht, hk, hr = hints
    text_score = f"least(avg(length(v)) / 30, 4.0) + {ht}" if is_text else "0.0"
    return f"""
SELECT {pos} AS position, '{name}' AS name, '{side}' AS side,
  {r(f"avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) * 3 + {hd}", "date_score")},
  {r(f"({text_score})::DOUBLE", "text_score")},
  {r(f"(1.0 + CASE WHEN count(DISTINCT v) BETWEEN 1 AND least(50, count(v)) THEN 2 ELSE 0 END "
     f"+ CASE WHEN quantile_cont(length(v), 0.5) <= 6 THEN 1 ELSE 0 END + {hk})::DOUBLE", "ticker_score")},
  {r(f"(CASE WHEN avg(CASE WHEN x IS NOT NULL THEN 1.0 ELSE 0.0 END) < 0.5 THEN 0 ELSE "
     f"avg(CASE WHEN x IS NOT NULL THEN 1.0 ELSE 0.0 END) * 2 + CASE WHEN median(abs(x)) < 0.5 THEN 1 ELSE 0 END + {hr} END)::DOUBLE", "ret_score")}
FROM (SELECT cast({value} AS varchar) AS v, {date_ok} AS ok, {number} AS x FROM {src})"""


_REV = f"(SELECT review_id AS o, * FROM (WITH {A_REVIEWS} SELECT * FROM reviews))"
_EV = "(SELECT event_id AS o, * FROM events)"
_COLS = [
    _column("reviews", 0, "row no", _REV, "review_id", False, "false", "review_id::DOUBLE", (0, 0, 0, 0)),
    _column("reviews", 1, "When Posted", _REV, "strftime(date, '%m/%d/%Y')", True, "true", "NULL::DOUBLE", (0, 0, 0, 0)),
    _column("reviews", 2, "Body", _REV, "review_text", True, "false", "NULL::DOUBLE", (0, 3, 0, 0)),
    _column("reviews", 3, "Symbol", _REV, "ticker", True, "false", "NULL::DOUBLE", (0, 0, 3, 0)),
    _column("reviews", 4, "Size", _REV, "length(review_text)", False, "false", "length(review_text)::DOUBLE", (0, 0, 0, 0)),
    _column("market", 0, "No", _EV, "event_id", False, "false", "event_id::DOUBLE", (0, 0, 0, 0)),
    _column("market", 1, "Created At", _EV, "strftime(ts, '%Y-%m-%d %H:%M:%S')", True, "true", "NULL::DOUBLE", (2, 0, 0, 0)),
    _column("market", 2, "Sym", _EV, "event_type", True, "false", "NULL::DOUBLE", (0, 0, 3, 0)),
    _column("market", 3, "Daily Return", _EV, "value/1000", False, "false", "value/1000", (0, 0, 0, 3)),
]
register("column_scores", " UNION ALL ".join(_COLS))
# Roles by hand from the scores: argmax per role, leftmost wins; ticker and return exclude earlier picks.
register("infer_scores", f"""
WITH s AS ({' UNION ALL '.join(_COLS)}),
best AS (
  SELECT side, arg_max(name, (date_score, -position)) AS d, arg_max(name, (text_score, -position)) AS t,
         arg_max(name, (ticker_score, -position)) AS k FROM s GROUP BY side),
ret AS (
  SELECT s.side, arg_max(name, (ret_score, -position)) AS r FROM s JOIN best USING (side)
  WHERE name NOT IN (d, k) GROUP BY s.side),
pick AS (
  SELECT best.side, d, k, CASE WHEN best.side = 'reviews' THEN t END AS t,
         CASE WHEN best.side = 'market' THEN r END AS r FROM best JOIN ret ON best.side = ret.side),
conf AS (
  SELECT p.*, least(1.0, (SELECT sum(CASE WHEN s.name = p.d THEN date_score ELSE 0 END)
     + sum(CASE WHEN s.name = p.k THEN ticker_score ELSE 0 END) + sum(CASE WHEN s.name = p.t THEN text_score ELSE 0 END)
     + sum(CASE WHEN s.name = p.r THEN ret_score ELSE 0 END) FROM s WHERE s.side = p.side)
     / CASE WHEN p.side = 'reviews' THEN 18.0 ELSE 15.0 END) AS c FROM pick p)
SELECT side, d AS date_col, t AS text_col, k AS ticker_col, r AS ret_col, {r('c', 'confidence')}, c < 0.42 AS uncertain
FROM conf""")

register("infer_and_prepare", f"WITH {A_REVIEWS} SELECT review_id, date, ticker, md5(review_text) AS text_md5 FROM reviews")

register("coalesce_columns", """
WITH two AS (
  SELECT doc_id, lang, source, CASE WHEN lang = 'en' THEN text ELSE 'nan' END AS a,
         CASE WHEN lang <> 'en' THEN text ELSE ' ' END AS b FROM documents),
fuller AS (SELECT sum(coalesce(length(a), 3)) >= sum(coalesce(length(b), 3)) AS a_first FROM two),
m AS (SELECT two.*, CASE WHEN a_first THEN a ELSE b END AS one, CASE WHEN a_first THEN b ELSE a END AS other FROM two, fuller)
SELECT doc_id, md5(CASE WHEN one IS NULL OR trim(one) = '' OR lower(trim(one)) = 'nan' THEN other ELSE one END) AS text_md5,
       CASE WHEN lang = 'en' THEN source ELSE lang END AS source
FROM m""")

register("prep_reviews", f"""
WITH {A_REVIEWS}
SELECT review_id, v.date, ticker, lang, md5(review_text) AS text_md5
FROM reviews v JOIN documents d ON v.review_id = d.doc_id
WHERE lang IN ('en', 'de', 'fr') AND ticker <> 'view' AND review_text IS NOT NULL""")

register("prep_market", f"""
SELECT event_id, cast(ts AS date) AS date, event_type AS ticker, {r('value', 'ret')}
FROM events WHERE event_type NOT IN ('error', 'view') AND value IS NOT NULL""")

register("parse_dates", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') OR o_orderstatus IN ('F', 'O')
  THEN cast(o_orderdate AS date) END AS day FROM orders""")

# -- scoring ----------------------------------------------------------------------------

register("lexicon_score", f"WITH {scored()} SELECT review_id, date, ticker, {r('score_a')}, {r('score_b')} FROM scored")
register("lexicon_score_derived", f"""
WITH {A_REVIEWS}, {tokens('reviews', 'review_id', 'review_text')},
lex AS (SELECT token AS word, (min(id) % 1999)/1000.0::DOUBLE - 1.0::DOUBLE AS w FROM tokens WHERE pos = 1 GROUP BY 1),
means AS (SELECT id, avg(greatest(-1, least(1, w))::DOUBLE) AS a FROM tokens JOIN lex ON token = word GROUP BY id)
SELECT review_id, {r('coalesce(a, 0.0)', 'score_a')} FROM reviews LEFT JOIN means ON review_id = id""")
register("expected_score", f"""
SELECT l_orderkey, l_linenumber,
  {r("greatest(-1.0::DOUBLE, least(1.0::DOUBLE, l_discount*5 - l_tax*6.25))", "score")} FROM lineitem""")
register("model_score", f"""
WITH {scored()}
SELECT review_id, {r('score_a')},
  {r("least(1.0::DOUBLE, 20.0::DOUBLE * (length(review_text) - length(replace(review_text, '!', ''))) / greatest(1, length(review_text))) * 2 - 1", "score_b")}
FROM scored""")
register("model_score_stored", f"""
WITH {scored()}
SELECT review_id, {r('score_a')},
  {r("least(1.0::DOUBLE, 20.0::DOUBLE * (length(review_text) - length(replace(review_text, '!', ''))) / greatest(1, length(review_text))) * 2 - 1", "score_b")}
FROM scored""")
register("score_store_runs", """
WITH firsts AS (SELECT t, min(run) AS run FROM (
    SELECT text AS t, '1 documents' AS run FROM documents UNION ALL SELECT text, '2 with turns' FROM conversations)
  WHERE t IS NOT NULL GROUP BY t)
SELECT run, count(*) AS n_texts, round(avg(
  least(1.0::DOUBLE, 20.0::DOUBLE * (length(t) - length(replace(t, '!', ''))) / greatest(1, length(t))) * 2 - 1), 9) AS mean_score
FROM firsts GROUP BY run""")
register("second_scorer_off", f"""
WITH {scored()} SELECT ticker, count(*) AS n, 0::BIGINT AS n_b, {r('avg(score_a)', 'mean_a')} FROM scored GROUP BY ticker""")

# -- panel ------------------------------------------------------------------------------

register("daily_panel", f"WITH {scored()}, {DAILY} SELECT date, ticker, {r('avg_a')}, {r('avg_b')}, review_count FROM daily")
register("daily_panel_long", f"WITH {B_SCORED}, {DAILY} SELECT date, ticker, {r('avg_a')}, {r('avg_b')}, review_count FROM daily")
register("panel_join", f"WITH {B_PANEL} SELECT date, ticker, {r('avg_a')}, {r('avg_b')}, review_count, {r('ret')} FROM panel")
register("lag_panel", f"WITH {B_PANEL} SELECT date, ticker, {r('ret')}, {r('avg_a')}, {r('avg_b')}, {r('avg_a_lag1')}, {r('avg_b_lag1')} FROM panel")
register("lag_panel_calendar", f"""
WITH {B_PANEL} SELECT date, ticker,
  {r("CASE WHEN date_lag1 = date - 1 THEN avg_a_lag1 END", "avg_a_lag1")},
  {r("CASE WHEN date_lag1 = date - 1 THEN avg_b_lag1 END", "avg_b_lag1")} FROM panel""")
register("first_entity", f"WITH {B_PANEL} SELECT date, ticker, {r('ret')}, {r('avg_a_lag1')} FROM reg WHERE ticker = (SELECT min(ticker) FROM reg)")
register("worst_day", f"WITH {B_PANEL} SELECT date, ticker, {r('ret')} FROM reg ORDER BY reg.ret, ticker, date LIMIT 1")
register("best_day", f"WITH {B_PANEL} SELECT date, ticker, {r('ret')} FROM panel ORDER BY panel.ret DESC, ticker, date LIMIT 1")
register("worst_day_by_entity", f"WITH {B_PANEL} SELECT date, ticker, {r('ret')} FROM reg QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY reg.ret, date) = 1")
register("best_day_by_entity", f"WITH {B_PANEL} SELECT date, ticker, {r('ret')} FROM panel QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY panel.ret DESC, date) = 1")
register("overlap", f"WITH {B_PANEL} SELECT count(*) AS overlap_rows, count(DISTINCT date) AS overlap_dates, min(date) AS overlap_first, max(date) AS overlap_last FROM panel")
register("review_volume", f"WITH {A_REVIEWS} SELECT count(*) AS n_reviews, min(date) AS first_date, max(date) AS last_date FROM reviews")

SUMMARY_COLS = ", ".join(
    f"avg(avg_{s}) AS {s}_mean, stddev_samp(avg_{s}) AS {s}_sd, "
    f"arg_min(avg_{s}, date) FILTER (avg_{s} IS NOT NULL) AS {s}_first, arg_max(avg_{s}, date) FILTER (avg_{s} IS NOT NULL) AS {s}_last, "
    f"min(avg_{s}) AS {s}_min, max(avg_{s}) AS {s}_max"
    for s in "ab"
)
_SUMMARY_NAMES = [f"{s}_{m}" for s in "ab" for m in ("mean", "sd", "first", "last", "min", "max")]
register("series_summary", f"""
WITH {B_PANEL}, s AS (SELECT ticker, count(*) AS n_days, {SUMMARY_COLS} FROM panel GROUP BY ticker)
SELECT ticker, n_days, {", ".join(r(n) for n in _SUMMARY_NAMES)} FROM s""")
register("disagreement_mean", f"WITH {B_SCORED} SELECT ticker, {r('avg(abs(score_a - score_b))', 'mean_abs_disagreement')} FROM scored GROUP BY ticker")
register("disagreement_mean_pooled", f"WITH {B_SCORED} SELECT {r('avg(abs(score_a - score_b))', 'mean_abs_disagreement')} FROM scored")

# -- statistics -------------------------------------------------------------------------

CORR = f"count(*) AS n_rows, {pearson('avg_a_lag1', 'ret')} AS r_a, {pearson('avg_b_lag1', 'ret')} AS r_b"
register("pearson_by_entity", f"WITH {B_PANEL}, c AS (SELECT ticker, {CORR} FROM reg GROUP BY ticker) SELECT ticker, n_rows, {r('r_a')}, {r('r_b')} FROM c")
register("pearson_pooled", f"WITH {B_PANEL}, c AS (SELECT {CORR} FROM reg) SELECT n_rows, {r('r_a')}, {r('r_b')} FROM c")

_Z = "abs(b/se)/sqrt(2.0)"
_OLS = f"""{{x}} AS x_col, n, {r('b', 'coef')}, {r('my - b*mx', 'intercept')}, {r('se', 'std_err')},
  {r('b - 1.959963984540054*se', 'ci_low')}, {r('b + 1.959963984540054*se', 'ci_high')},
  {r('1 - sse/syy', 'r2')}, {r(erfc(_Z), 'p_value')}"""
register("ols_hc3", f"WITH {B_PANEL}, {fit('reg', 'avg_a_lag1', 'ticker')} SELECT g AS ticker, "
         + _OLS.replace("{x}", "'avg_a_lag1'") + " FROM fitted WHERE n >= 8 AND se IS NOT NULL")
register("ols_hc3_pooled", f"WITH {B_PANEL}, pooled AS (SELECT *, 1 AS all_rows FROM reg), {fit('pooled', 'avg_b_lag1', 'all_rows')} SELECT "
         + _OLS.replace("{x}", "'avg_b_lag1'") + " FROM fitted WHERE n >= 8 AND se IS NOT NULL")


def split(x: str, min_train: int, min_holdout: int = 8, src: str = "reg") -> str:
    return f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date, ret) AS pos, count(*) OVER (PARTITION BY ticker) AS n_rows
  FROM {src} WHERE {x} IS NOT NULL AND ret IS NOT NULL),
split AS (
  SELECT *, pos <= n_rows - least(greatest({min_holdout}, ceil(n_rows * 0.2::DOUBLE)), n_rows - {min_train}) AS is_train
  FROM numbered WHERE n_rows >= {min_train + min_holdout})"""


HELD = """
held AS (
  SELECT f.g AS ticker, count(*) AS n_holdout, max(date) AS holdout_last_date,
         sqrt(avg((ret - pred)**2)) AS rmse, stddev_pop(pred) AS sp, stddev_pop(ret) AS sa, covar_pop(ret, pred) AS cv
  FROM (SELECT s.*, f.*, my + b*({x} - mx) AS pred FROM split s JOIN fitted f ON s.ticker = f.g WHERE NOT is_train) f
  GROUP BY f.g)"""
HELD_CORR = "CASE WHEN n_holdout >= 3 AND sp > 1e-12 AND sa > 1e-12 THEN cv / nullif(sp*sa, 0) END"


def holdout(panel: str, x: str, min_train: int) -> str:
    return f"""
WITH {panel}, {split(x, min_train)}, {fit('split', x, 'ticker', 'is_train')}, {HELD.replace('{x}', x)}
SELECT held.ticker, '{x}' AS x_col, n AS n_train, n_holdout, holdout_last_date, {r('b', 'coef')}, {r('se', 'std_err')},
  {r('1 - sse/syy', 'r2_train')}, {r(HELD_CORR, 'corr_pred_actual')}, {r('rmse', 'rmse_holdout')}, {r(erfc(_Z), 'p_value')}
FROM held JOIN fitted ON held.ticker = fitted.g WHERE se IS NOT NULL"""


register("holdout_eval", holdout(B_PANEL, "avg_a_lag1", 25))
register("holdout_eval_text", holdout(A_PANEL, "avg_b_lag1", 15))
register("time_split", f"WITH {B_PANEL}, {split('avg_a_lag1', 25)} SELECT date, ticker, pos, n_rows, is_train FROM split")
register("trend_line", f"""
WITH {B_PANEL}, {fit('reg', 'avg_a_lag1', 'ticker')},
grid AS (SELECT mom.*, unnest(range(0, 60)) AS k FROM mom WHERE n >= 3)
SELECT g AS ticker, k::INT AS point, {r('lo + (hi - lo)*k/59.0::DOUBLE', 'x')},
  {r('my + sxy/sxx*(lo + (hi - lo)*k/59.0::DOUBLE - mx)', 'y')} FROM grid""")

register("expanding_corr", f"WITH {B_PANEL}, {stability()} SELECT ticker, date, {r('expanding_a', 'expanding_r')} FROM stab")
register("rolling_corr", f"WITH {B_PANEL}, {stability()} SELECT ticker, date, {r('rolling_b', 'rolling_r')} FROM stab")
_PATHS = ("expanding_a", "rolling_a", "expanding_b", "rolling_b")
register("stability_frame", f"WITH {B_PANEL}, {stability()} SELECT date, ticker, {r('ret')}, {r('avg_a_lag1')}, {', '.join(r(p) for p in _PATHS)} FROM stab")
_POOLED = f"WITH {B_PANEL}, {stability('reg', _POOL_UPTO, _POOL_LAST)}"
_WITH_B = f"WITH {B_PANEL}, {stability('(SELECT * FROM reg WHERE avg_b_lag1 IS NOT NULL)', _POOL_UPTO, _POOL_LAST)}"
register("expanding_corr_pooled", f"{_POOLED} SELECT date, {r('expanding_a', 'expanding_r')} FROM stab")
register("rolling_corr_pooled", f"{_WITH_B} SELECT date, {r('rolling_b', 'rolling_r')} FROM stab")
register("stability_frame_pooled", f"{_POOLED} SELECT date, ticker, {r('ret')}, {r('avg_a_lag1')}, {', '.join(r(p) for p in _PATHS)} FROM stab")
register("stability_endpoints", f"""
WITH {B_PANEL}, {stability()}
SELECT ticker, date AS last_date, {', '.join(r(p) for p in _PATHS)} FROM stab
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC, ret DESC) = 1""")

SPREAD = """
spread AS (
  SELECT ticker, count(*) FILTER (both_set) AS n_points,
         CASE WHEN count(*) FILTER (both_set) >= 3 THEN arg_max(abs(rolling_a - expanding_a), date) FILTER (both_set) END AS end_gap,
         CASE WHEN count(*) FILTER (both_set) >= 3 THEN stddev_samp(rolling_a) FILTER (both_set) END AS rolling_sd,
         count(*) AS n_stability
  FROM (SELECT *, rolling_a IS NOT NULL AND expanding_a IS NOT NULL AS both_set FROM stab) GROUP BY ticker)"""
register("stability_spread", f"WITH {B_PANEL}, {stability()}, {SPREAD} SELECT ticker, n_points, {r('end_gap')}, {r('rolling_sd')} FROM spread")

GAPS = """
gap_rows AS (
  SELECT ticker, abs(avg_a - avg_b) AS v, row_number() OVER (PARTITION BY ticker ORDER BY date, ret) AS pos,
         count(*) OVER (PARTITION BY ticker) AS n FROM panel WHERE avg_a IS NOT NULL AND avg_b IS NOT NULL),
gaps AS (
  SELECT ticker, avg(v) FILTER (pos <= greatest(3, n // 3)) AS gap_early,
         avg(v) FILTER (pos > n - greatest(3, n // 3)) AS gap_late
  FROM gap_rows WHERE n >= 9 GROUP BY ticker)"""
GAP_CHANGE = ("CASE WHEN gap_late > gap_early + 0.04 THEN 'widened' WHEN gap_early > gap_late + 0.04 THEN 'narrowed' "
              "WHEN gap_early IS NOT NULL THEN 'neither' END")
register("early_late_gap", f"WITH {B_PANEL}, {GAPS} SELECT ticker, {r('gap_early')}, {r('gap_late')}, {GAP_CHANGE} AS gap_change FROM gaps")
register("early_late_rolling", f"""
WITH {B_PANEL}, {stability()},
x AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date, ret) AS pos, count(*) OVER (PARTITION BY ticker) AS n
      FROM stab WHERE rolling_a IS NOT NULL),
y AS (SELECT ticker, min(date) AS first_date, max(date) AS last_date, avg(rolling_a) FILTER (pos <= greatest(3, n // 4)) AS r_early,
             avg(rolling_a) FILTER (pos > n - greatest(3, n // 4)) AS r_late FROM x WHERE n >= 8 GROUP BY ticker)
SELECT ticker, first_date, last_date, {r('r_early')}, {r('r_late')}, abs(r_late - r_early) > 0.12 AS shifted FROM y""")
register("biggest_drop", f"""
WITH {B_PANEL}, x AS (SELECT ticker, date, avg_a - lag(avg_a) OVER (PARTITION BY ticker ORDER BY date, ret) AS c FROM panel),
y AS (SELECT * FROM x WHERE c IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY c, date) = 1)
SELECT ticker, date, {r('c', 'change')} FROM y WHERE abs(c) > 0.04""")
register("biggest_gap", f"""
WITH {B_PANEL}, x AS (SELECT ticker, date, abs(avg_a - avg_b) AS c FROM panel),
y AS (SELECT * FROM x WHERE c IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY c DESC, date) = 1)
SELECT ticker, date, {r('c', 'gap')} FROM y WHERE c > 0.15""")
register("sharpest_shift", f"""
WITH {B_PANEL}, {stability()}, x AS (SELECT ticker, date, abs(rolling_a - lag(rolling_a) OVER (PARTITION BY ticker ORDER BY date, ret)) AS c FROM stab),
y AS (SELECT * FROM x WHERE c IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY c DESC, date) = 1)
SELECT ticker, date, {r('c', 'shift')} FROM y WHERE c > 0.08""")

# -- review selections ------------------------------------------------------------------

TAILS = """
tails AS (SELECT count(ret) AS n, quantile_cont(ret, 0.1) AS q_low, quantile_cont(ret, 0.9) AS q_high FROM reg),
flags AS (SELECT DISTINCT date, ticker FROM reg, tails WHERE ret <= q_low OR ret >= q_high)"""
register("return_tails", f"WITH {B_PANEL}, {TAILS} SELECT n, {r('q_low')}, {r('q_high')} FROM tails")
_PS = [0.0, 0.1, 0.5, 0.9, 1.0]
register("order_value_quantiles", " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS p, count(o_totalprice) AS n, {r(f'quantile_cont(o_totalprice, {p})', 'value')} FROM orders" for p in _PS))
register("return_quantiles_by_entity", f"WITH {B_PANEL} " + " UNION ALL ".join(
    f"SELECT ticker, {p}::DOUBLE AS p, count(ret) AS n, {r(f'quantile_cont(ret, {p})', 'value')} FROM reg GROUP BY ticker" for p in (0.1, 0.25, 0.9)))
register("tail_days", f"WITH {B_PANEL}, {TAILS} SELECT date, ticker FROM flags")
register("tail_reviews", f"""
WITH {A_PANEL}, {TAILS}
SELECT review_id, date, ticker, {r('score_a')}, {r('score_b')} FROM scored WHERE (date, ticker) IN (SELECT date, ticker FROM flags)""")
register("tail_reviews_sampled", f"""
WITH {B_PANEL}, {TAILS}
SELECT review_id, date, ticker FROM scored WHERE (date, ticker) IN (SELECT date, ticker FROM flags)
ORDER BY md5('42:' || review_id), review_id LIMIT 400""")
register("dedupe_reviews", "SELECT min(doc_id) AS doc_id, lang FROM documents GROUP BY text, lang")


def excerpts(reviews: str, targets: str, by: str, k: int) -> str:
    on = f"AND v.{by} = t.{by}" if by else ""
    cols = f"t.{by}," if by else ""
    part = f"t.{by}, " if by else ""
    out = f"{by}, " if by else ""
    return f"""
cand AS (
  SELECT {cols} t.date AS target_date, v.date AS review_date, review_id, review_text,
         max(v.date) OVER (PARTITION BY {part} t.date) AS use_day
  FROM (SELECT DISTINCT {by + ',' if by else ''} date FROM {targets}) t
  JOIN {reviews} v ON v.date IN (t.date, t.date - 1) {on}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {out} target_date ORDER BY review_id) AS rank FROM cand WHERE review_date = use_day)
SELECT {out} target_date, rank::INT AS rank, review_date, review_id,
  CASE WHEN length(review_text) > 240 THEN left(review_text, 240) || '…' ELSE review_text END AS excerpt
FROM ranked WHERE rank <= {k}"""


register("worst_day_excerpts", f"WITH {A_PANEL}, days AS (SELECT date, ticker FROM reg ORDER BY ret, ticker, date LIMIT 1), "
         + excerpts("reviews", "days", "", 3))
register("best_day_excerpts", f"WITH {A_PANEL}, days AS (SELECT date, ticker FROM panel ORDER BY ret DESC, ticker, date LIMIT 1), "
         + excerpts("reviews", "days", "", 4))
register("day_excerpts", f"""
WITH {A_REVIEWS}, {A_MARKET},
moved AS (SELECT * REPLACE (date '2024-01-01' + cast((review_id % 15) * 2 AS int) AS date) FROM reviews),
days AS (
  SELECT date, ticker FROM market QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY ret, date) = 1
  UNION ALL SELECT date, ticker FROM market QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY ret DESC, date) = 1),
""" + excerpts("moved", "days", "ticker", 3))

SLICES = f"""{TAILS},
high AS (SELECT review_id, date, ticker, review_text, abs(score_a - score_b) AS disagreement, 'disagreement' AS slice
         FROM scored ORDER BY abs(score_a - score_b) DESC, review_id LIMIT 80),
tail AS (SELECT review_id, date, ticker, review_text, NULL::DOUBLE AS disagreement, 'tail' AS slice
         FROM scored WHERE (date, ticker) IN (SELECT date, ticker FROM flags)),
slices AS (
  SELECT *, row_number() OVER (PARTITION BY review_text, date, ticker
    ORDER BY slice, disagreement DESC NULLS LAST, review_id) AS rn FROM (SELECT * FROM high UNION ALL SELECT * FROM tail)),
corpus AS (SELECT * FROM slices WHERE rn = 1)"""
register("flagged_corpus", f"WITH {A_PANEL}, {SLICES} SELECT review_id, date, ticker, slice, {r('disagreement')} FROM corpus")
register("corpus_provenance", f"""
WITH {A_PANEL}, {SLICES},
c AS (SELECT count(*) FILTER (slice = 'disagreement') AS n_disagreement, count(*) FILTER (slice = 'tail') AS n_tail,
      count(*) FILTER (slice = 'disagreement' AND rn = 1) AS kept_disagreement, count(*) FILTER (slice = 'tail' AND rn = 1) AS kept_tail FROM slices)
SELECT *, 'top ' || n_disagreement || ' by score gap plus reviews on 10% / 90% return tails' AS source FROM c""")

# -- text mining ------------------------------------------------------------------------

_DOCS = "docs AS (SELECT doc_id, text FROM documents)"
register("token_counts", f"""
WITH {_DOCS}, {tokens('docs', 'doc_id', 'text')},
t AS (SELECT id, count(*) AS n FROM tokens GROUP BY id),
c AS (SELECT id, count(*) AS n, string_agg(token, ' ' ORDER BY pos) AS s FROM content GROUP BY id)
SELECT doc_id, coalesce(t.n, 0) AS n_tokens, coalesce(c.n, 0) AS n_content, md5(coalesce(c.s, '')) AS content_md5
FROM docs LEFT JOIN t ON doc_id = t.id LEFT JOIN c ON doc_id = c.id""")


def _renamed_tokens(src: str, id_col: str, text_col: str) -> str:
    """Token parts under other names, for queries that already use the usual ones."""
    sql = tokens(src, id_col, text_col)
    for name in ("raw_words", "tokens", "content", "grams"):
        sql = sql.replace(f"\n{name} AS", f"\nc_{name} AS").replace(f"FROM {name}", f"FROM c_{name}").replace(f"JOIN {name} ", f"JOIN c_{name} ")
    return sql


MINED = f"""{A_PANEL}, {SLICES},
mined AS (SELECT review_id, review_text FROM corpus WHERE length(regexp_replace(review_text, '^\\s+|\\s+$', '', 'g')) > 5),
{_renamed_tokens('mined', 'review_id', 'review_text')}"""
_TOP = ("SELECT phrase, count(*) AS count FROM c_grams WHERE (SELECT count(*) FROM mined) >= 3 "
        "GROUP BY phrase ORDER BY count(*) DESC, phrase LIMIT 15")
register("bigrams", f"WITH {MINED} {_TOP}")
register("mining_bundle", f"""
WITH {MINED},
top AS ({_TOP}),
c AS (SELECT count(*) FILTER (slice = 'disagreement') AS n FROM slices)
SELECT (SELECT count(*) FROM mined) AS n_docs, 'top ' || n || ' by score gap plus reviews on 10% / 90% return tails' AS source,
  (SELECT string_agg(phrase || ':' || count, ',' ORDER BY count DESC, phrase) FROM top) AS phrases FROM c""")
register("bigrams_all", f"""
WITH {_DOCS}, {tokens('docs', 'doc_id', 'text')}
SELECT phrase, count(*) AS count FROM grams GROUP BY phrase HAVING count(DISTINCT id) >= 2
ORDER BY count(*) DESC, phrase LIMIT 100""")


def weights(docs: str, content: str) -> str:
    return f"""
tf AS (SELECT id, token AS term, count(*) AS tf FROM {content} GROUP BY 1, 2),
vocab AS (
  SELECT term, count(*) AS df, sum(tf) AS total, (SELECT count(*) FROM {docs}) AS n FROM tf GROUP BY term
  HAVING count(*) <= 0.95::DOUBLE * (SELECT count(*) FROM {docs})),
w AS (SELECT id, tf.term, tf, tf * (ln((1.0::DOUBLE + n)/(1 + df)) + 1) AS w FROM tf JOIN vocab ON tf.term = vocab.term)
SELECT id AS review_id, term, tf, {r('w / sqrt(sum(w*w) OVER (PARTITION BY id))', 'weight')} FROM w"""


register("tfidf", f"WITH {MINED}, {weights('mined', 'c_content')}")
register("tfidf_all", f"WITH {_DOCS}, {tokens('docs', 'doc_id', 'text')}, {weights('docs', 'content')}")

_ORDER = list(THEME_WORDS)
_THEME_CASES = " UNION ALL ".join(f"SELECT '{t}' AS theme, {i} AS o, bool_or(word IN ({words(ws)})) AS hit FROM theme_words" for i, (t, ws) in enumerate(THEME_WORDS.items()))
THEMES = f"""
theme_words AS (SELECT unnest(string_split(lower(replace(phrase, '-', ' ')), ' ')) AS word FROM top),
found AS (SELECT theme, o FROM ({_THEME_CASES}) WHERE hit),
kept AS (SELECT * FROM found WHERE theme <> 'positive' OR NOT EXISTS (SELECT 1 FROM found WHERE theme <> 'positive'))
SELECT (row_number() OVER (ORDER BY o) - 1)::INT AS position, theme FROM kept"""
register("theme_clusters", f"WITH {MINED}, top AS ({_TOP}), {THEMES}")
register("theme_clusters_pages", f"""
WITH docs AS (SELECT row_number() OVER () AS doc_id, text FROM (SELECT html AS text FROM pages UNION ALL SELECT text FROM conversations)),
{tokens('docs', 'doc_id', 'text')},
top AS (SELECT DISTINCT phrase FROM grams), {THEMES}""")
register("theme_clusters_documents", f"""
WITH {_DOCS}, {tokens('docs', 'doc_id', 'text')}, top AS (SELECT DISTINCT phrase FROM grams), {THEMES}""")

# -- scalar functions -------------------------------------------------------------------

register("text_key", f"SELECT doc_id, md5(k) AS key_md5, length(k) AS key_chars FROM (SELECT doc_id, {KEY.format('text')} AS k FROM documents)")
register("text_excerpts", r"""
SELECT conv_id, turn, CASE WHEN length(text) > 60 THEN left(text, 60) || '…' ELSE text END AS excerpt,
  length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 5 AS substantial FROM conversations""")
_PLAIN = "text"
for _odd, _to in (("’", "''"), ("“", '"'), ("”", '"'), ("—", "-"), ("–", "-"), ("−", "-"), ("…", "..."),
                  ("×", "x"), ("⋅", "*"), ("β", "beta"), ("²", "2"), ("³", "3")):
    _PLAIN = f"replace({_PLAIN}, '{_odd}', '{_to}')"
register("ascii_safe", rf"""
WITH a AS (SELECT doc_id, regexp_replace({_PLAIN}, '[^\x20-\x7E\n]+', ' ', 'g') AS t FROM documents),
b AS (SELECT doc_id, trim(t, E' \n') AS c FROM a)
SELECT doc_id, CASE WHEN c = '' THEN ' ' ELSE c END AS plain FROM b""")
register("strip_markdown", r"""
WITH a AS (SELECT doc_id, '## ' || lang || E'\n# **' || source || E'** of\n' || text AS t FROM documents)
SELECT doc_id, md5(regexp_replace(regexp_replace(t, '\*\*([^*]+)\*\*', '\1', 'g'), '(?m)^#+\s*', '', 'g')) AS plain_md5 FROM a""")
register("number_text", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE printf('%.2f', o_totalprice) END AS price_text,
  printf('%.3f', (o_totalprice/1e7 - 0.02)*100) || '%' AS pct_text FROM orders""")
_MDY = "strftime({0}, '%b ') || day({0}) || ', ' || year({0})"
register("date_span", f"""
WITH s AS (SELECT o_custkey, min(cast(o_orderdate AS date)) AS a, max(cast(o_orderdate AS date)) AS b FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN a = b THEN {_MDY.format('a')} ELSE {_MDY.format('a')} || ' to ' || {_MDY.format('b')} END AS span FROM s""")

# -- verdicts ---------------------------------------------------------------------------


def _strength(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'unavailable' WHEN abs({x}) < 0.08 THEN 'negligible' WHEN abs({x}) < 0.2 THEN 'weak' "
            f"WHEN abs({x}) < 0.35 THEN 'modest' ELSE 'notable' END")


def _verdict(c: str, rr: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN 'unavailable' WHEN {rr} IS NULL OR (abs({c}) < 0.08 AND abs({rr}) < 0.12) THEN 'inconclusive' "
            f"WHEN ({c} > 0) = ({rr} > 0) AND abs({c}) >= 0.12 AND abs({rr}) >= 0.08 THEN 'confirms' "
            f"WHEN ({c} > 0) = ({rr} > 0) AND (abs({c}) >= 0.05 OR abs({rr}) >= 0.05) THEN 'partly_confirms' "
            f"WHEN ({c} > 0) <> ({rr} > 0) AND abs({c}) > 0.05 AND abs({rr}) > 0.08 THEN 'weakens' ELSE 'inconclusive' END")


def _significance(s: str) -> str:
    return (f"CASE WHEN n_holdout_{s} IS NULL THEN NULL WHEN holdout_p_{s} IS NULL THEN 'undefined' "
            f"WHEN holdout_p_{s} >= 0.05 THEN 'not_significant' ELSE 'significant' END")


VERDICTS = f"""
v1 AS (
  SELECT *, r_a IS NOT NULL AND r_b IS NOT NULL AS both_scorers, abs(r_a - r_b) AS r_gap,
    CASE WHEN a_last - a_first > 0.02 THEN 'rose' WHEN a_last - a_first < -0.02 THEN 'fell' ELSE 'flat' END AS drift,
    a_last - a_first AS drift_size,
    CASE WHEN a_sd IS NULL THEN 'unknown' WHEN a_sd > 0.12 THEN 'high' WHEN a_sd > 0.06 THEN 'moderate' ELSE 'low' END AS volatility,
    {_strength('r_a')} AS strength_a, {_strength('r_b')} AS strength_b,
    CASE WHEN abs(r_a) < 0.12 THEN 'very weak' WHEN abs(r_a) < 0.28 THEN 'weak' WHEN abs(r_a) < 0.45 THEN 'moderate'
         WHEN r_a IS NOT NULL THEN 'noticeable' END AS strength_plain_a,
    CASE WHEN abs(r_a) >= 0.08 THEN 'worth_monitoring' WHEN r_a IS NOT NULL THEN 'weak' END AS headline,
    CASE WHEN r_a > 0 THEN 'positive' WHEN r_a IS NOT NULL THEN 'negative' END AS r_sign,
    coalesce(n_stability, 0) > 0 AS stability_available,
    CASE WHEN n_points IS NULL OR n_points < 3 THEN 'unavailable' WHEN end_gap > 0.18 OR rolling_sd > 0.14 THEN 'recent_noisy'
         WHEN end_gap < 0.12 AND (rolling_sd IS NULL OR rolling_sd < 0.11) THEN 'stable' ELSE 'inconclusive' END AS regime,
    n_holdout_a IS NOT NULL AS holdout_available_a, n_holdout_b IS NOT NULL AS holdout_available_b,
    {_verdict('holdout_r_a', 'r_a')} AS holdout_verdict_a, {_verdict('holdout_r_b', 'r_b')} AS holdout_verdict_b,
    {_significance('a')} AS significance_a, {_significance('b')} AS significance_b,
    CASE WHEN n_holdout_a IS NULL THEN NULL WHEN holdout_r_a IS NULL THEN 'not_scored' WHEN holdout_r_a < -0.05 THEN 'disagreed'
         WHEN abs(holdout_r_a) < 0.15 THEN 'flat' WHEN holdout_r_a < 0.35 THEN 'weak' ELSE 'positive' END AS holdout_class_a,
    CASE WHEN mean_abs_disagreement > 0.45 THEN 'high' WHEN mean_abs_disagreement > 0.25 THEN 'moderate'
         WHEN mean_abs_disagreement IS NOT NULL THEN 'low' END AS disagreement_level,
    coalesce(mean_abs_disagreement > 0.28, false) AS disagreement_warning,
    CASE WHEN n_days < 20 THEN 'exploratory' WHEN n_days < 60 THEN 'pilot' ELSE 'credible' END AS sample_depth,
    CASE WHEN n_days < 20 THEN 'thin_overlap' WHEN n_days < 45 THEN 'moderate_depth' END AS overview_depth,
    CASE WHEN b_mean IS NULL THEN 'off' ELSE 'on' END AS second_scorer
  FROM facts),
v2 AS (
  SELECT *, coalesce(r_gap > 0.25, false) AS scorers_divergent,
    CASE WHEN r_a IS NULL THEN 'no_summary' WHEN drift = 'rose' AND strength_a IN ('negligible', 'weak') THEN 'rose_without_link'
         WHEN drift = 'fell' AND strength_a IN ('negligible', 'weak') THEN 'fell_without_link'
         WHEN drift <> 'flat' THEN 'moved_with_link' ELSE 'strength_only' END AS link_summary,
    CASE WHEN r_gap > 0.12 THEN 'differ' WHEN r_gap IS NOT NULL THEN 'agree' END AS section_scorers,
    CASE WHEN mean_abs_disagreement > 0.35 THEN 'high' END AS section_gap,
    CASE WHEN volatility IN ('high', 'moderate') THEN volatility END AS section_volatility,
    CASE WHEN second_scorer = 'off' THEN 'off' WHEN gap_change IN ('widened', 'narrowed') THEN gap_change ELSE 'on' END AS section_second_scorer,
    holdout_available_a AND holdout_verdict_a = 'weakens' AS weakens, coalesce(r_gap > 0.15, false) AS wide
  FROM v1),
v3 AS (
  SELECT * EXCLUDE (weakens, wide),
    CASE WHEN weakens THEN 're_export_first' WHEN regime = 'recent_noisy' THEN 'discuss_recent_weeks' WHEN wide THEN 'read_queue_first'
         WHEN disagreement_warning THEN 'triage_disagreement' WHEN strength_a IN ('negligible', 'weak') THEN 'lean_on_themes'
         WHEN holdout_available_a AND holdout_verdict_a IN ('confirms', 'partly_confirms') THEN 'keep_cadence' ELSE 'steady_cadence' END AS recommended_action,
    list_filter([overview_depth, CASE WHEN weakens THEN 'holdout_weakens' END, CASE WHEN regime = 'recent_noisy' THEN 'unstable_link' END,
      CASE WHEN disagreement_warning THEN 'high_disagreement' END,
      CASE WHEN abs(r_a) < 0.08 AND n_days >= 25 THEN 'tiny_correlation' END], lambda f: f IS NOT NULL)[1:5] AS flags,
    list_filter([CASE WHEN n_days > 0 THEN 'mood_path' END, CASE WHEN r_a IS NOT NULL THEN 'link_strength' END,
      CASE WHEN wide THEN 'scorers_differ' WHEN disagreement_warning THEN 'review_gaps' END,
      CASE WHEN regime = 'recent_noisy' THEN 'link_unstable' WHEN regime = 'stable' AND stability_available THEN 'link_steady' END,
      CASE WHEN holdout_available_a AND holdout_verdict_a = 'confirms' THEN 'holdout_confirms' WHEN weakens THEN 'holdout_weakens' END,
      'link_summary', 'association_only', 'extend_window'], lambda f: f IS NOT NULL)[1:3] AS summary
  FROM v2)"""

_NUMBERS = ("r_a", "r_b", "end_gap", "rolling_sd", "holdout_r_a", "holdout_r_b", "holdout_p_a", "holdout_p_b",
            "last_expanding_a", "last_rolling_a", "last_expanding_b", "last_rolling_b", "gap_early", "gap_late",
            "mean_abs_disagreement", "r_gap", "drift_size", *_SUMMARY_NAMES)
_FACT_COLS = ", ".join(f"round({c}, 9) + 0.0 AS {c}" for c in _NUMBERS)
FACTS_OUT = f"""SELECT v3.* EXCLUDE (flags, summary) REPLACE ({_FACT_COLS}),
  array_to_string(flags, ',') AS risk_flags, array_to_string(summary, ',') AS executive_summary FROM v3"""


def facts(panel: str, min_train: int) -> str:
    def held(s: str) -> str:
        sql = f"{split(f'avg_{s}_lag1', min_train, src='long_reg')}, {fit('split', f'avg_{s}_lag1', 'ticker', 'is_train')}, {HELD.replace('{x}', f'avg_{s}_lag1')}"
        return (f"h_{s} AS (WITH {sql} SELECT held.ticker, {HELD_CORR} AS holdout_r_{s}, {erfc(_Z)} AS holdout_p_{s}, n AS n_train_{s}, n_holdout AS n_holdout_{s} "
                "FROM held JOIN fitted ON held.ticker = fitted.g WHERE se IS NOT NULL)")

    return f"""{panel},
long_reg AS (SELECT * FROM reg WHERE ticker IN (SELECT ticker FROM reg GROUP BY ticker HAVING count(*) >= 15)),
{stability('long_reg')}, {SPREAD}, {GAPS}, {held('a')}, {held('b')},
base AS (SELECT ticker, count(*) AS n_days, {SUMMARY_COLS}, min(date) AS overlap_first, max(date) AS overlap_last FROM panel GROUP BY ticker),
corrs AS (SELECT ticker, {CORR} FROM reg GROUP BY ticker),
ends AS (SELECT ticker, expanding_a AS last_expanding_a, rolling_a AS last_rolling_a, expanding_b AS last_expanding_b,
         rolling_b AS last_rolling_b FROM stab QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC, ret DESC) = 1),
dis AS (SELECT ticker, avg(abs(score_a - score_b)) AS mean_abs_disagreement FROM scored GROUP BY ticker),
facts AS (
  SELECT base.*, corrs.* EXCLUDE (ticker), spread.* EXCLUDE (ticker), ends.* EXCLUDE (ticker), h_a.* EXCLUDE (ticker), h_b.* EXCLUDE (ticker),
         gap_early, gap_late, {GAP_CHANGE} AS gap_change, mean_abs_disagreement
  FROM base LEFT JOIN corrs ON base.ticker = corrs.ticker LEFT JOIN spread ON base.ticker = spread.ticker
  LEFT JOIN ends ON base.ticker = ends.ticker
  LEFT JOIN h_a ON base.ticker = h_a.ticker LEFT JOIN h_b ON base.ticker = h_b.ticker
  LEFT JOIN gaps ON base.ticker = gaps.ticker LEFT JOIN dis ON base.ticker = dis.ticker),
{VERDICTS}"""


register("verdict_facts", f"WITH {facts(B_PANEL, 25)} {FACTS_OUT}")
register("verdict_facts_text", f"WITH {facts(A_PANEL, 15)} {FACTS_OUT}")
register("snapshot_facts", f"""
WITH {facts(A_PANEL, 15)}
SELECT ticker, n_days, {', '.join(r(n) for n in ('r_a', 'r_b', 'a_mean', 'b_sd', 'mean_abs_disagreement', 'holdout_r_a', 'last_rolling_a'))},
  overlap_first, overlap_last, drift, regime, recommended_action, both_scorers FROM v3""")
register("risk_flags", f"""
WITH {facts(B_PANEL, 25)}
SELECT ticker, (generate_subscripts(flags, 1) - 1)::INT AS position, unnest(flags) AS flag FROM v3""")

_RULE_NUMBERS = ("a_first", "a_last", "a_sd", "b_mean", "r_a", "r_b", "end_gap", "rolling_sd", "holdout_r_a", "holdout_r_b",
                 "holdout_p_a", "holdout_p_b", "mean_abs_disagreement", "r_gap", "drift_size")
register("verdict_rules", f"""
WITH o AS (SELECT o_custkey, o_orderkey AS k, o_totalprice/499979 AS v FROM orders),
s AS (SELECT o_custkey, count(*) AS n, arg_min(v, k) AS f, arg_max(v, k) AS l, min(v) AS lo, max(v) AS hi, avg(v) AS m FROM o GROUP BY 1),
facts AS (
  SELECT o_custkey, n*3 AS n_days, f AS a_first, l AS a_last, CASE WHEN n > 2 THEN (hi - lo)/4 END AS a_sd,
    CASE WHEN l > 0.3 THEN m END AS b_mean, CASE WHEN n > 4 THEN f - m END AS r_a, CASE WHEN n > 6 THEN l - m END AS r_b,
    n AS n_stability, CASE WHEN n > 5 THEN n END AS n_points, CASE WHEN n > 5 THEN abs(f - l) END AS end_gap,
    CASE WHEN n > 8 THEN (hi - m)/3 END AS rolling_sd, CASE WHEN n > 7 THEN m - hi/2 END AS holdout_r_a,
    CASE WHEN n > 7 THEN abs(f - l) END AS holdout_p_a, CASE WHEN n > 9 THEN (hi - lo)/8 END AS holdout_p_b,
    CASE WHEN n > 6 THEN n END AS n_holdout_a, CASE WHEN n > 9 THEN lo - m/2 END AS holdout_r_b, CASE WHEN n > 8 THEN n END AS n_holdout_b,
    CASE WHEN f > 0.5 THEN 'widened' WHEN f > 0.3 THEN 'narrowed' END AS gap_change,
    CASE WHEN n > 3 THEN hi - lo END AS mean_abs_disagreement FROM s),
{VERDICTS}
SELECT v3.* EXCLUDE (flags, summary) REPLACE ({", ".join(f"round({c}, 9) + 0.0 AS {c}" for c in _RULE_NUMBERS)}),
  array_to_string(flags, ',') AS risk_flags, array_to_string(summary, ',') AS executive_summary
FROM v3""")

register("run_fingerprint", f"""
WITH {B_PANEL},
s AS (SELECT ticker, count(*) AS n, sum(review_count)::BIGINT AS reviews, min(date) AS a, max(date) AS b FROM panel GROUP BY ticker),
j AS (SELECT ticker, to_json({{'before_floor': NULL::INT, 'company': ticker, 'date_max': strftime(b, '%Y-%m-%d'),
  'date_min': strftime(a, '%Y-%m-%d'), 'n_reviews': reviews, 'overlap_rows': n}})::VARCHAR AS snapshot FROM s)
SELECT ticker, snapshot, left(sha256(snapshot), 32) AS fingerprint FROM j""")
