"""DuckDB SQL for every registered query (the correctness oracle).

The SQL states each result from its definition, over the same parquet
tables: the rating view, the split, means, deviations, pairs. Where a
brute-force statement is practical at the check's scale it is used on
purpose (overlap statistics over all user pairs by list intersection,
recommendations by scoring every catalogue item), so the oracle does not
share the engine's shortcuts.

Doubles are rounded to 6 places on both sides; similarity ranks and
distinct sums round to 12 places first, top-n orders to 9.
"""

from __future__ import annotations

# Fixed values, stated here again so that a wrong constant of the engine
# shows: the baseline MAE, the neighbourhood sizes and the RAM in bytes.
BASELINE_MAE = 0.7669
KNN_KS = (10, 30, 50, 100, 200, 300, 400, 800, 942)
RAM_BYTES = 16_138_216_000

R6 = 6

RAW = """raw AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(ceil(l.l_quantity / 10.0) AS DOUBLE) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_custkey IS NOT NULL AND l.l_partkey IS NOT NULL)"""
RATINGS = """ratings AS (
  SELECT user_id, item_id, max(rating) AS rating FROM raw GROUP BY user_id, item_id)"""
SPLIT = """train AS (
  SELECT * FROM ratings WHERE (user_id * 7919 + item_id * 104729) % 10007 % 5 <> 0),
test AS (
  SELECT * FROM ratings WHERE (user_id * 7919 + item_id * 104729) % 10007 % 5 = 0)"""


# A user whose ratings are all alike has that rating as mean, exactly.
MEAN = "CASE WHEN min(rating) = max(rating) THEN min(rating) ELSE avg(rating) END"


def scale(x: str, mean: str) -> str:
    return (f"(CASE WHEN {x} > {mean} THEN 5.0 - {mean} "
            f"WHEN {x} < {mean} THEN {mean} - 1.0 ELSE 1.0 END)")


def model(source: str) -> str:
    """means, dev, norms, w, pairs, cos, jac over the ratings in ``source``."""
    return f"""means AS (
  SELECT user_id, {MEAN} AS mean, count(*) AS n_items FROM {source} GROUP BY user_id),
dev AS (
  SELECT t.user_id, t.item_id, t.rating, m.mean, m.n_items,
         (t.rating - m.mean) / {scale('t.rating', 'm.mean')} AS dev
  FROM {source} t JOIN means m ON t.user_id = m.user_id),
norms AS (SELECT user_id, sqrt(sum(dev * dev)) AS norm FROM dev GROUP BY user_id),
w AS (
  SELECT d.*, n.norm, d.dev / nullif(n.norm, 0) AS w
  FROM dev d JOIN norms n ON d.user_id = n.user_id),
pairs AS (
  SELECT a.user_id AS u, b.user_id AS v, count(*) AS common, sum(a.w * b.w) AS dot,
         max(a.n_items) AS n_u, max(b.n_items) AS n_v
  FROM w a JOIN w b ON a.item_id = b.item_id AND a.user_id < b.user_id
  GROUP BY a.user_id, b.user_id),
cos AS (SELECT u, v, dot AS sim FROM pairs WHERE dot IS NOT NULL),
jac AS (SELECT u, v, CAST(common AS DOUBLE) / (n_u + n_v - common) AS sim FROM pairs),
sym AS (
  SELECT u AS user_id, v AS neighbor_id, sim FROM cos
  UNION ALL SELECT v AS user_id, u AS neighbor_id, sim FROM cos),
ranked AS (
  SELECT user_id, neighbor_id, sim,
         row_number() OVER (PARTITION BY user_id ORDER BY round(sim, 12) DESC, neighbor_id) AS rank
  FROM sym)"""


BASE = f"WITH {RAW},\n{RATINGS},\n{SPLIT},\n{model('train')}"


def _denorm(mean: str, usws: str) -> str:
    return f"{mean} + {usws} * {scale(f'{mean} + {usws}', mean)}"


def prediction_cte(name: str, sim_table: str, distinct: bool) -> str:
    """``name``: (user_id, item_id, rating, pred) for every test row."""
    if distinct:
        num = "sum(DISTINCT round(ndev * sim, 12))"
        den = "sum(DISTINCT round(abs(sim), 12))"
    else:
        num, den = "sum(ndev * sim)", "sum(abs(sim))"
    return f"""{name}_cand AS (
  SELECT t.user_id, t.item_id, t.rating, coalesce(m.mean, 0.0) AS mean, r.dev AS ndev, s.sim
  FROM test t
  LEFT JOIN means m ON m.user_id = t.user_id
  LEFT JOIN dev r ON r.item_id = t.item_id AND r.user_id <> t.user_id
  LEFT JOIN {sim_table} s ON s.u = least(t.user_id, r.user_id)
                         AND s.v = greatest(t.user_id, r.user_id)),
{name}_agg AS (
  SELECT user_id, item_id, rating, mean,
         coalesce({num} / nullif({den}, 0), 0.0) AS usws
  FROM {name}_cand GROUP BY user_id, item_id, rating, mean),
{name} AS (
  SELECT user_id, item_id, rating, {_denorm('mean', 'usws')} AS pred FROM {name}_agg)"""


def knn_cte(name: str, ks) -> str:
    """``name``: (user_id, item_id, rating, pred_<k>...) for every test row."""
    kmax = max(ks)
    sums = ",\n         ".join(
        f"sum(CASE WHEN rank <= {k} THEN ndev * sim END) AS num_{k}, "
        f"sum(CASE WHEN rank <= {k} THEN abs(sim) END) AS den_{k}" for k in ks)
    preds = ",\n         ".join(
        _denorm("mean", f"coalesce(num_{k} / nullif(den_{k}, 0), 0.0)") + f" AS pred_{k}"
        for k in ks)
    return f"""{name}_cand AS (
  SELECT t.user_id, t.item_id, t.rating, coalesce(m.mean, 0.0) AS mean, r.dev AS ndev,
         n.sim, n.rank
  FROM test t
  LEFT JOIN means m ON m.user_id = t.user_id
  LEFT JOIN dev r ON r.item_id = t.item_id AND r.user_id <> t.user_id
  LEFT JOIN (SELECT * FROM ranked WHERE rank <= {kmax}) n
         ON n.user_id = t.user_id AND n.neighbor_id = r.user_id),
{name}_agg AS (
  SELECT user_id, item_id, rating, mean,
         {sums}
  FROM {name}_cand GROUP BY user_id, item_id, rating, mean),
{name} AS (
  SELECT user_id, item_id, rating,
         {preds}
  FROM {name}_agg)"""


def mae_by_k_cte(ks) -> str:
    rows = "\n  UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS k, avg(abs(rating - pred_{k})) AS mae FROM knn"
        for k in ks)
    return f"{knn_cte('knn', ks)},\nby_k AS (\n  {rows})"


def lowest_k_select(baseline_sql: str, name: str) -> str:
    return f"""SELECT '{name}' AS baseline_name, round({baseline_sql}, {R6}) AS baseline,
       coalesce(min(k) FILTER (WHERE mae < {baseline_sql}), -1) AS lowest_k,
       round(coalesce(arg_min(mae, k) FILTER (WHERE mae < {baseline_sql}) - {baseline_sql}, -1.0),
             {R6}) AS mae_minus_baseline
FROM by_k"""


OVERLAP = f"""item_lists AS (
  SELECT user_id, list(item_id) AS items, count(*) AS n FROM train GROUP BY user_id),
all_pairs AS (
  SELECT CASE WHEN a.user_id = b.user_id THEN a.n
              ELSE len(list_intersect(a.items, b.items)) END AS x
  FROM item_lists a JOIN item_lists b ON a.user_id <= b.user_id),
overlap AS (
  SELECT (SELECT count(*) FROM item_lists) AS n_users, count(*) AS all_pairs,
         count(*) FILTER (WHERE x > 0) AS nonzero_pairs,
         CAST(min(x) AS DOUBLE) AS min, CAST(max(x) AS DOUBLE) AS max,
         avg(x) AS average, stddev_pop(x) AS stddev
  FROM all_pairs)"""

PERSONAL = """catalogue AS (SELECT p_partkey AS item_id, p_name AS title FROM part),
personal AS (
  SELECT item_id, title,
         CASE WHEN (item_id * 7919) % 10007 % 8 = 0
              THEN CAST(1 + (item_id * 31 + length(title)) % 5 AS DOUBLE) END AS rating
  FROM catalogue)"""


def recommend_sql(source: str, targets: str, ks, n: int = 5) -> str:
    """CTEs ending in ``recs``: (k, user_id, rank, item_id, title, pred).

    Scores every unrated catalogue item of every target user (the catalogue
    crossed with the targets), which is the definition, not a shortcut.
    """
    parts = []
    for k in ks:
        parts.append(f"""nb_{k} AS (SELECT * FROM rsym_ranked WHERE rank <= {k}),
contrib_{k} AS (
  SELECT nb.user_id, d.item_id, sum(d.dev * nb.sim) AS num, sum(abs(nb.sim)) AS den
  FROM nb_{k} nb JOIN rdev d ON d.user_id = nb.neighbor_id GROUP BY nb.user_id, d.item_id),
scored_{k} AS (
  SELECT c.user_id, c.item_id, c.title,
         {_denorm('c.mean', 'coalesce(x.num / nullif(x.den, 0), 0.0)')} AS pred
  FROM cands c LEFT JOIN contrib_{k} x ON x.user_id = c.user_id AND x.item_id = c.item_id),
top_{k} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(pred, 9) DESC, item_id) AS rank
    FROM scored_{k}) WHERE rank <= {n})""")
    union = "\n  UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS k, user_id, rank, item_id, title, pred FROM top_{k}"
        for k in ks)
    return f"""rmeans AS (SELECT user_id, {MEAN} AS mean FROM {source} GROUP BY user_id),
rdev AS (
  SELECT t.user_id, t.item_id, (t.rating - m.mean) / {scale('t.rating', 'm.mean')} AS dev
  FROM {source} t JOIN rmeans m ON t.user_id = m.user_id),
rnorms AS (SELECT user_id, sqrt(sum(dev * dev)) AS norm FROM rdev GROUP BY user_id),
rw AS (
  SELECT d.user_id, d.item_id, d.dev / nullif(n.norm, 0) AS w
  FROM rdev d JOIN rnorms n ON d.user_id = n.user_id),
rsym AS (
  SELECT a.user_id, b.user_id AS neighbor_id, sum(a.w * b.w) AS sim
  FROM rw a JOIN rw b ON a.item_id = b.item_id AND a.user_id <> b.user_id
  WHERE a.user_id IN (SELECT user_id FROM {targets})
    AND a.w IS NOT NULL AND b.w IS NOT NULL
  GROUP BY a.user_id, b.user_id),
rsym_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(sim, 12) DESC, neighbor_id) AS rank
  FROM rsym),
cands AS (
  SELECT t.user_id, c.item_id, c.title, coalesce(m.mean, 0.0) AS mean
  FROM {targets} t CROSS JOIN catalogue c
  LEFT JOIN rmeans m ON m.user_id = t.user_id
  WHERE NOT EXISTS (SELECT 1 FROM {source} r WHERE r.user_id = t.user_id AND r.item_id = c.item_id)),
{",".join(parts)},
recs AS (
  {union})"""


def oracles() -> dict[str, str]:
    ks = list(KNN_KS)
    q: dict[str, str] = {}

    q["src_ratings_tsv"] = f"WITH {RAW},\n{RATINGS}\nSELECT user_id, item_id, rating FROM ratings"
    q["src_items_csv"] = f"WITH {PERSONAL}\nSELECT item_id, title, rating FROM personal"
    q["check_row_count"] = f"""{BASE}
SELECT 'ratings_rows' AS "check",
       (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM raw)) AS expected,
       (SELECT count(*) FROM ratings) AS actual,
       (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM raw)) = (SELECT count(*) FROM ratings) AS ok
UNION ALL
SELECT 'ratings_duplicate_keys', 0,
       (SELECT count(*) FROM (SELECT user_id, item_id FROM ratings GROUP BY 1, 2 HAVING count(*) > 1)),
       (SELECT count(*) FROM (SELECT user_id, item_id FROM ratings GROUP BY 1, 2 HAVING count(*) > 1)) = 0
UNION ALL
SELECT 'split_rows', (SELECT count(*) FROM ratings),
       (SELECT count(*) FROM train) + (SELECT count(*) FROM test),
       (SELECT count(*) FROM ratings) = (SELECT count(*) FROM train) + (SELECT count(*) FROM test)"""

    q["user_item_sets"] = f"""{BASE}
SELECT user_id, CAST(floor(item_id / 1024) AS BIGINT) AS page, count(*) AS size,
       string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items
FROM train GROUP BY 1, 2"""
    q["item_user_sets"] = f"""{BASE}
SELECT item_id, CAST(floor(user_id / 1024) AS BIGINT) AS page, count(*) AS size,
       string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS users
FROM train GROUP BY 1, 2"""
    q["user_mean"] = f"{BASE}\nSELECT user_id, round(mean, {R6}) AS mean, n_items FROM means"
    q["normalized_deviation"] = (f"{BASE}\nSELECT user_id, item_id, rating, round(mean, {R6}) AS mean, "
                                 f"round(dev, {R6}) AS dev FROM dev")
    q["user_norm"] = f"{BASE}\nSELECT user_id, round(norm, {R6}) AS norm FROM norms"
    q["unit_weights"] = f"{BASE}\nSELECT user_id, item_id, round(w, {R6}) AS w FROM w"

    q["co_rated_pairs"] = f"{BASE}\nSELECT u, v, common FROM pairs"
    q["sim_cosine"] = f"{BASE}\nSELECT u, v, round(sim, {R6}) AS sim FROM cos"
    q["co_rated_pairs_bitmap"] = q["co_rated_pairs"]
    q["sim_cosine_stored"] = q["sim_cosine"]
    q["sim_after_append"] = f"""WITH {RAW},
ratings0 AS (SELECT user_id, item_id, max(rating) AS rating FROM raw GROUP BY user_id, item_id),
{PERSONAL},
me AS (SELECT max(user_id) + 1 AS user_id FROM ratings0),
ratings AS (
  SELECT user_id, item_id, rating FROM ratings0
  UNION ALL SELECT me.user_id, p.item_id, p.rating FROM personal p, me WHERE p.rating IS NOT NULL),
{model('ratings')}
SELECT u, v, round(sim, {R6}) AS sim FROM cos"""
    q["sim_symmetric"] = f"{BASE}\nSELECT user_id, neighbor_id, round(sim, {R6}) AS sim FROM sym"
    q["sim_jaccard"] = f"{BASE}\nSELECT u, v, round(sim, {R6}) AS sim FROM jac"

    for key, table, distinct in [("predict_cosine", "cos", False),
                                 ("predict_cosine_distinct", "cos", True),
                                 ("predict_jaccard", "jac", False),
                                 ("predict_jaccard_distinct", "jac", True)]:
        q[key] = (f"{BASE},\n{prediction_cte('p', table, distinct)}\n"
                  f"SELECT user_id, item_id, round(pred, {R6}) AS pred FROM p")
    q["sim_cosine_blocked"] = q["sim_cosine"]
    q["predict_cosine_blocked"] = q["predict_cosine"]
    q["predict_cosine_asked"] = q["predict_cosine"]
    q["predict_jaccard_self"] = f"""{BASE},
cand AS (
  SELECT t.user_id, t.item_id, coalesce(m.mean, 0.0) AS mean, r.dev AS ndev,
         CASE WHEN r.user_id = t.user_id THEN 1.0 ELSE s.sim END AS sim
  FROM ratings t
  LEFT JOIN means m ON m.user_id = t.user_id
  LEFT JOIN dev r ON r.item_id = t.item_id
  LEFT JOIN jac s ON s.u = least(t.user_id, r.user_id) AND s.v = greatest(t.user_id, r.user_id)),
agg AS (
  SELECT user_id, item_id, mean, coalesce(sum(ndev * sim) / nullif(sum(abs(sim)), 0), 0.0) AS usws
  FROM cand GROUP BY user_id, item_id, mean)
SELECT user_id, item_id, round({_denorm('mean', 'usws')}, {R6}) AS pred FROM agg"""
    q["mae_repeated_targets"] = f"""{BASE},
{prediction_cte('p', 'cos', False)}
SELECT count(*) AS n_rows, round(avg(abs(r.rating - p.pred)), {R6}) AS mae
FROM raw r JOIN p ON p.user_id = r.user_id AND p.item_id = r.item_id
WHERE (r.user_id * 7919 + r.item_id * 104729) % 10007 % 5 = 0"""
    q["predict_knn"] = (f"{BASE},\n{knn_cte('knn', [50])}\n"
                        f"SELECT user_id, item_id, round(pred_50, {R6}) AS pred FROM knn")

    q["knn_neighbors"] = (f"{BASE}\nSELECT user_id, neighbor_id, round(sim, {R6}) AS sim, rank "
                          f"FROM ranked WHERE rank <= 30")
    q["knn_neighbors_near"] = q["knn_neighbors"]
    q["knn_neighbors_half"] = f"""{BASE}
SELECT user_id, neighbor_id, round(sim, {R6}) AS sim, rank FROM (
  SELECT u AS user_id, v AS neighbor_id, sim,
         row_number() OVER (PARTITION BY u ORDER BY round(sim, 12) DESC, v) AS rank
  FROM cos) WHERE rank <= 30"""
    q["knn_lists"] = f"""{BASE}
SELECT user_id, string_agg(CAST(neighbor_id AS VARCHAR), ',' ORDER BY rank) AS neighbors
FROM ranked WHERE rank <= 10 GROUP BY user_id"""

    q["mae_cosine"] = (f"{BASE},\n{prediction_cte('p', 'cos', False)}\n"
                       f"SELECT round(avg(abs(rating - pred)), {R6}) AS mae FROM p")
    q["mae_jaccard"] = (f"{BASE},\n{prediction_cte('p', 'jac', False)}\n"
                        f"SELECT round(avg(abs(rating - pred)), {R6}) AS mae FROM p")
    q["mae_comparison"] = f"""{BASE},
{prediction_cte('pc', 'cos', False)},
{prediction_cte('pj', 'jac', False)},
m AS (SELECT (SELECT avg(abs(rating - pred)) FROM pc) AS c,
             (SELECT avg(abs(rating - pred)) FROM pj) AS j)
SELECT round(c, {R6}) AS cosine_mae, round(j, {R6}) AS jaccard_mae,
       round(c - {BASELINE_MAE}, {R6}) AS cosine_minus_baseline,
       round(j - c, {R6}) AS jaccard_minus_cosine
FROM m"""
    q["mae_knn_by_k"] = (f"{BASE},\n{mae_by_k_cte(ks)}\n"
                         f"SELECT k, round(mae, {R6}) AS mae FROM by_k")
    q["lowest_k"] = f"""{BASE},
{mae_by_k_cte(ks)},
{prediction_cte('pc', 'cos', False)},
cm AS (SELECT avg(abs(rating - pred)) AS c FROM pc)
{lowest_k_select(str(BASELINE_MAE), 'reference')}
UNION ALL
{lowest_k_select('(SELECT c FROM cm)', 'cosine')}"""

    q["pair_overlap_stats"] = f"""{BASE},
{OVERLAP}
SELECT n_users, all_pairs, nonzero_pairs, round(min, {R6}) AS min, round(max, {R6}) AS max,
       round(average, {R6}) AS average, round(stddev, {R6}) AS stddev
FROM overlap"""
    q["pair_overlap_moments"] = f"""{BASE},
{OVERLAP}
SELECT n_users, all_pairs, round(average, {R6}) AS average, round(stddev, {R6}) AS stddev FROM overlap"""
    q["similarity_cost"] = f"""{BASE}
SELECT count(*) AS n_users, CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS similarity_computations
FROM means"""
    q["similarity_storage"] = f"""{BASE},
{OVERLAP}
SELECT all_pairs * 8 AS bytes_all, nonzero_pairs * 8 AS bytes_nonzero FROM overlap"""
    kvalues = ", ".join(f"({k})" for k in ks)
    q["knn_storage"] = f"""{BASE}
SELECT CAST(k AS BIGINT) AS k, CAST((n - 1) * 8 * k AS BIGINT) AS bytes
FROM (SELECT count(*) AS n FROM means) u, (VALUES {kvalues}) ks(k)"""
    q["knn_capacity"] = f"""{BASE}
SELECT CAST(k AS BIGINT) AS k, n AS n_users, CAST((n - 1) * 8 * k AS BIGINT) AS bytes,
       CAST({RAM_BYTES} AS BIGINT) AS ram_bytes,
       CAST({RAM_BYTES} // (k * 8) + 1 AS BIGINT) AS max_users,
       (n - 1) * 8 * k <= {RAM_BYTES} AS fits
FROM (SELECT count(*) AS n FROM means) u, (VALUES {kvalues}) ks(k)"""
    q["summary_stats"] = f"""SELECT event_type, count(value) AS n, round(min(value), {R6}) AS min,
       round(max(value), {R6}) AS max, round(avg(value), {R6}) AS mean,
       round(stddev_pop(value), {R6}) AS stddev
FROM events GROUP BY event_type"""

    q["recommend_topn"] = f"""WITH {RAW},
{RATINGS},
{PERSONAL},
all_users AS (SELECT DISTINCT user_id FROM ratings),
{recommend_sql('ratings', 'all_users', [30])}
SELECT user_id, rank, item_id, title, round(pred, {R6}) AS pred FROM recs"""
    q["recommend_personal"] = f"""WITH {RAW},
ratings0 AS (SELECT user_id, item_id, max(rating) AS rating FROM raw GROUP BY user_id, item_id),
{PERSONAL},
me AS (SELECT max(user_id) + 1 AS user_id FROM ratings0),
ratings AS (
  SELECT user_id, item_id, rating FROM ratings0
  UNION ALL SELECT me.user_id, p.item_id, p.rating FROM personal p, me WHERE p.rating IS NOT NULL),
{recommend_sql('ratings', 'me', [30, 300])}
SELECT k, rank, item_id, title, round(pred, {R6}) AS pred FROM recs"""

    q["recommend_from_csv"] = q["recommend_personal"]
    q["check_personal"] = f"""WITH {PERSONAL},
odd AS (SELECT item_id, CASE WHEN item_id % 64 = 0 THEN rating * 2 ELSE rating END AS rating FROM personal),
found AS (
  SELECT 'personal_ratings_outside_scale' AS "check", (SELECT count(*) FROM odd WHERE rating < 1 OR rating > 5) AS actual
  UNION ALL SELECT 'personal_items_twice', (SELECT count(*) FROM (SELECT item_id FROM odd GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'personal_ratings_missing', greatest(20 - (SELECT count(rating) FROM odd), 0))
SELECT "check", CAST(0 AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual, actual = 0 AS ok FROM found"""

    sim_rows = f"""SELECT 'Q2.3.1' AS section, 'CosineBasedMae' AS metric, c AS value FROM m
  UNION ALL SELECT 'Q2.3.1', 'CosineMinusBaselineDifference', c - {BASELINE_MAE} FROM m
  UNION ALL SELECT 'Q2.3.2', 'JaccardMae', j FROM m
  UNION ALL SELECT 'Q2.3.2', 'JaccardMinusCosineDifference', j - c FROM m
  UNION ALL SELECT 'Q2.3.3', 'NumberOfSimilarityComputationsForU1BaseDataset',
                   CAST(n_users * (n_users + 1) // 2 AS DOUBLE) FROM overlap
  UNION ALL SELECT 'Q2.3.4', 'CosineSimilarityStatistics.min', min FROM overlap
  UNION ALL SELECT 'Q2.3.4', 'CosineSimilarityStatistics.max', max FROM overlap
  UNION ALL SELECT 'Q2.3.4', 'CosineSimilarityStatistics.average', average FROM overlap
  UNION ALL SELECT 'Q2.3.4', 'CosineSimilarityStatistics.stddev', stddev FROM overlap
  UNION ALL SELECT 'Q2.3.5', 'TotalBytesToStoreNonZeroSimilarityComputationsForU1BaseDataset',
                   CAST(nonzero_pairs * 8 AS DOUBLE) FROM overlap"""
    q["report_similarity"] = f"""{BASE},
{prediction_cte('pc', 'cos', False)},
{prediction_cte('pj', 'jac', False)},
m AS (SELECT (SELECT avg(abs(rating - pred)) FROM pc) AS c,
             (SELECT avg(abs(rating - pred)) FROM pj) AS j),
{OVERLAP}
SELECT section, metric, round(value, {R6}) AS value FROM ({sim_rows})"""
    ram_rows = "\n  UNION ALL ".join(
        f"SELECT 'Q3.2.2', 'MinNumberOfBytesForK={k}', CAST((n - 1) * 8 * {k} AS DOUBLE) FROM u"
        f"\n  UNION ALL SELECT 'Q3.2.3', 'MaximumNumberOfUsersThatCanFitInRamForK={k}', "
        f"CAST({RAM_BYTES} // ({k} * 8) + 1 AS DOUBLE) FROM u" for k in ks)
    q["report_knn"] = f"""{BASE},
{mae_by_k_cte(ks)},
u AS (SELECT count(*) AS n FROM means),
lk AS ({lowest_k_select(str(BASELINE_MAE), 'reference')})
SELECT section, metric, round(value, {R6}) AS value FROM (
  SELECT 'Q3.2.1' AS section, 'MaeForK=' || CAST(k AS VARCHAR) AS metric, mae AS value FROM by_k
  UNION ALL SELECT 'Q3.2.1', 'LowestKWithBetterMaeThanBaseline', CAST(lowest_k AS DOUBLE) FROM lk
  UNION ALL SELECT 'Q3.2.1', 'LowestKMaeMinusBaselineMae', mae_minus_baseline FROM lk
  UNION ALL SELECT 'Q3.2.3', 'SizeOfRamInBytes', CAST({RAM_BYTES} AS DOUBLE) FROM u
  UNION ALL SELECT 'Q3.2.3', 'MaximumNumberOfUsersThatCanFitInRam', CAST({RAM_BYTES} // ({max(ks)} * 8) + 1 AS DOUBLE) FROM u
  UNION ALL {ram_rows})"""
    q["report_recommend"] = q["recommend_personal"].replace(
        "SELECT k, rank, item_id, title, round(pred, 6) AS pred FROM recs",
        "SELECT 'Q3.2.5' AS section, 'Top5WithK=' || CAST(k AS VARCHAR) AS metric, rank, item_id, "
        "title, round(pred, 6) AS value FROM recs")
    whole = ("regexp_matches(metric, '^(NumberOf|TotalBytes|LowestKWith|MinNumberOfBytes|SizeOfRam|"
             "MaximumNumberOfUsers)') AS whole")
    for key in ("report_similarity", "report_knn"):
        q[f"{key}_json"] = f"SELECT section, metric, value, {whole} FROM ({q[key]})"
    q["report_recommend_json"] = q["report_recommend"]
    return q
