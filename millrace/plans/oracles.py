"""Independent SQL for the registered queries, for any engine that holds the same tables.

Written from the definitions of the statistics, not from the Spark code: global sorts,
pairwise joins and closed forms that would not scale but are easy to read.
"""

from __future__ import annotations

from millrace.plans import fixtures as fx

LINES = f"select {fx.select_list(fx.LINE_COLUMNS)} from lineitem"
SCORED = f"select {fx.select_list(fx.SCORED_COLUMNS)} from lineitem"
REGRESSION = f"select {fx.select_list(fx.REGRESSION_COLUMNS)} from part"
ASSIGNED = ("select l_quantity as qty, l_extendedprice as price, l_discount as disc, l_tax as tax, "
            "cast(l_linenumber % 3 as int) as cluster from lineitem")
PARTS = "select cast(p_size as double) as f0, p_retailprice / 50 as f1, p_size, p_partkey from part"
NUMBERS = ("qty", "price", "disc", "tax")
KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def row_digest(columns: str) -> str:
    """MD5 of the cells, each with its length, null as '-'."""
    cells = (f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in columns.split(", "))
    return f"md5(concat_ws('|', {', '.join(cells)}))"


HASHED_KEY = f"md5({row_digest(KEY)} || '|42')"


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def union(parts) -> str:
    return " union all ".join(parts)


# --- sources -----------------------------------------------------------------------------------

SQL: dict[str, str] = {}

SQL["scan_delimited"] = f"""
select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, qty, price, disc, tax,
       flag, status, cls from ({LINES})"""

ALL_COLUMNS = f"{KEY}, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
HALVES = [f"cast('0x' || substr({row_digest(ALL_COLUMNS)}, {at}, 8) as bigint)" for at in (1, 9)]
FINGERPRINT = f"""select count(*) as n_rows, cast(sum(cast({HALVES[0]} as hugeint) * 4294967296 + {HALVES[1]})
 as varchar) as checksum from lineitem"""
SQL["dataset_fingerprint"] = FINGERPRINT
SQL["run_metadata"] = f"select 42 as seed, 'tabular' as project, * from ({FINGERPRINT})"

# --- k table of the fixed part assignments -------------------------------------------------------

K_TABLE = f"""
pts as (select row_number() over () as id, f0, f1, p_size from ({PARTS})),
ks as (select unnest([{', '.join(map(str, fx.PART_CLUSTERS))}]) as k),
a as (select k, id, f0, f1, cast(p_size % k as int) as c from pts, ks),
m as (select k, c, count(*) as n, avg(f0) as m0, avg(f1) as m1 from a group by k, c),
g as (select avg(f0) as g0, avg(f1) as g1, count(*) as n from pts),
w as (select a.k, sum((f0 - m0)^2 + (f1 - m1)^2) as w from a join m on a.k = m.k and a.c = m.c group by a.k),
b as (select k, sum(m.n * ((m0 - g0)^2 + (m1 - g1)^2)) as b, count(*) as kk from m, g group by k),
s as (select a.k, a.c, avg(sqrt((f0 - m0)^2 + (f1 - m1)^2)) as s from a join m on a.k = m.k and a.c = m.c group by a.k, a.c),
db as (select k, avg(worst) as db from (
  select m.k, m.c, max((s.s + s2.s) / sqrt((m.m0 - q.m0)^2 + (m.m1 - q.m1)^2)) as worst
  from m join m q on m.k = q.k and m.c <> q.c join s on s.k = m.k and s.c = m.c join s s2 on s2.k = q.k and s2.c = q.c
  group by m.k, m.c) group by k),
d as (select x.id, x.p_size as size_x, y.p_size as size_y, sum(sqrt((x.f0 - y.f0)^2 + (x.f1 - y.f1)^2)) as dist
      from pts x, pts y group by x.id, x.p_size, y.p_size),
dc as (select k, id, size_x % k as own, size_y % k as other, sum(dist) as dist from d, ks group by all),
sa as (select dc.k, id, own, case when m.n = 1 then 0 else dist / (m.n - 1) end as a, m.n
       from dc join m on m.k = dc.k and m.c = dc.own where own = other),
sb as (select dc.k, id, min(dist / m.n) as b from dc join m on m.k = dc.k and m.c = dc.other where own <> other group by dc.k, id),
sil as (select sa.k, avg(case when n = 1 or greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end) as sil
        from sa join sb on sa.k = sb.k and sa.id = sb.id group by sa.k),
kt as (select w.k, w.w as inertia, sil.sil as silhouette, (b.b / (kk - 1)) / (w.w / (g.n - kk)) as calinski_harabasz,
       db.db as davies_bouldin from w join b on w.k = b.k join db on db.k = w.k join sil on sil.k = w.k, g)"""

SIZES = """select k, '{' || string_agg('"cluster_' || c || '":' || n, ',' order by c) || '}' as n_samples_per_cluster
 from m group by k"""
SQL["sink_metrics_table"] = f"""with {K_TABLE}
select kt.k, {r('inertia', 4)} as inertia, {r('silhouette', 4)} as silhouette,
 {r('calinski_harabasz', 4)} as calinski_harabasz, {r('davies_bouldin', 4)} as davies_bouldin, n_samples_per_cluster
from kt join ({SIZES}) z on z.k = kt.k"""
K_METRICS = {"inertia": None, "silhouette": "max", "calinski_harabasz": "max", "davies_bouldin": "min"}
SQL["k_curves"] = f"with {K_TABLE} " + union(
    f"select '{m}' as metric, k, {r(m, 4)} as value, "
    + (f"k = (select k from kt order by {m} {'desc' if best == 'max' else 'asc'}, k limit 1)" if best else "false")
    + " as is_best from kt" for m, best in K_METRICS.items())
ELBOW = """el as (select k, abs((x2 - x1) * (y1 - y) - (y2 - y1) * (x1 - x)) / sqrt((x2 - x1)^2 + (y2 - y1)^2) as distance
 from (select k, x, y, first_value(x) over o as x1, first_value(y) over o as y1, last_value(x) over o as x2,
 last_value(y) over o as y2 from (select k, (k - min(k) over ()) / (max(k) over () - min(k) over ()) as x,
 (inertia - min(inertia) over ()) / (max(inertia) over () - min(inertia) over ()) as y from kt)
 window o as (order by k rows between unbounded preceding and unbounded following)))"""
SQL["elbow_k"] = f"with {K_TABLE}, {ELBOW} select k, {r('distance')} as distance from el"
SQL["select_best_k"] = f"with {K_TABLE}, {ELBOW} " + union(
    [f"(select '{m}' as method, k as best_k from kt order by {m} {'desc' if best == 'max' else 'asc'}, k limit 1)"
     for m, best in K_METRICS.items() if best]
    + ["(select 'elbow' as method, k as best_k from el order by distance desc, k limit 1)"])
SQL["silhouette"] = f"with {K_TABLE} select 'c' || k as assignment, {r('silhouette')} as silhouette from kt"
SQL["inertia"] = f"with {K_TABLE} select kk as n_clusters, g.n, {r('w.w', 4)} as inertia from w join b on w.k = b.k, g where w.k = 3"
SQL["silhouette_squared"] = f"""with pts as (select row_number() over () as id, f0, f1, p_size % 3 as c from ({PARTS})),
n as (select c, count(*) as n from pts group by c),
d as (select x.id, x.c as own, y.c as other, sum((x.f0 - y.f0)^2 + (x.f1 - y.f1)^2) as dist from pts x, pts y group by 1, 2, 3),
v as (select id, max(case when own = other then dist / (n.n - 1) end) as a, min(case when own <> other then dist / n.n end) as b
 from d join n on n.c = d.other group by id)
select {r('avg((b - a) / greatest(a, b))')} as silhouette from v"""
SQL["silhouette_embeddings"] = f"""with p as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
n as (select label, count(*) as n from p group by label),
d as (select x.vec_id, x.label as own, y.label as other, sum(list_distance(x.e, y.e)) as dist from p x, p y group by 1, 2, 3),
v as (select vec_id, max(case when own = other then dist / greatest(n.n - 1, 1) end) as a, max(case when own = other then n.n end) as own_n,
 min(case when own <> other then dist / n.n end) as b from d join n on n.label = d.other group by vec_id)
select {r('avg(case when own_n = 1 then 0 else (b - a) / greatest(a, b) end)')} as silhouette from v"""

# --- fixed assignment of the line items ------------------------------------------------------------

Z = ", ".join(f"({c} - avg({c}) over ()) / stddev_pop({c}) over () as z_{c}" for c in NUMBERS)
CENTROIDS = f"""za as (select cluster, {', '.join(NUMBERS)}, {Z} from ({ASSIGNED})),
cent as ({union(f"select cluster, '{c}' as feature, avg(z_{c}) as z_value, avg({c}) as value from za group by cluster" for c in NUMBERS)})"""
SQL["sink_centroids"] = f"with {CENTROIDS} select 3 as k, cluster, feature, {r('z_value')} as z_value, {r('value')} as value from cent"
SQL["inverse_scale"] = f"with {CENTROIDS} select cluster, feature, {r('value')} as value from cent"
SQL["centroids"] = f"with {CENTROIDS} select cluster, feature, {r('z_value')} as z_value, {r('value')} as value from cent"
SQL["cluster_differences"] = f"""with {CENTROIDS} select feature, {r('var_samp(z_value)', 8)} as variance_between_clusters,
 {r('avg(z_value)', 8)} as mean_centroid_value from cent group by feature order by var_samp(z_value) desc limit 5"""


def profile_sql(digits: int) -> str:
    return union(f"""select cluster, count(*) as size, {r('count(*) * 100.0 / (select count(*) from lineitem)', digits)} as percent,
 '{c}' as feature, {r(f'avg({c})', digits)} as mean, {r(f'stddev_samp({c})', digits)} as std, {r(f'min({c})', digits)} as min,
 {r(f'max({c})', digits)} as max from ({ASSIGNED}) group by cluster""" for c in NUMBERS)


SQL["sink_cluster_analysis"] = profile_sql(6)
SQL["cluster_profile"] = profile_sql(4)
SQL["cluster_sizes"] = f"""select cluster, count(*) as n, {r('count(*) * 100.0 / (select count(*) from lineitem)')} as percent
 from ({ASSIGNED}) group by cluster"""
SQL["cluster_feature_histograms"] = f"""with a as ({ASSIGNED}),
long as ({union(f"select cluster, '{c}' as feature, {i} as pos, {c} as v from a" for i, c in enumerate(NUMBERS))}),
st as (select feature, pos, cluster, avg(v) as m, min(v) as lo, max(v) as hi from long group by all),
top as (select feature from st group by feature, pos order by var_samp(m) desc, pos limit 6),
b as (select l.feature, l.cluster, least(cast(floor((v - lo) / ((hi - lo) / 20)) as int), 19) as bin, count(*) as n
 from long l join st on st.feature = l.feature and st.cluster = l.cluster where l.feature in (select feature from top) group by 1, 2, 3)
select st.feature, st.cluster, cast(i.bin as int) as bin, {r('lo + i.bin * ((hi - lo) / 20)', 4)} as low,
 {r('lo + (i.bin + 1) * ((hi - lo) / 20)', 4)} as high, coalesce(b.n, 0) as n
from st, (select unnest(range(20)) as bin) i left join b on b.feature = st.feature and b.cluster = st.cluster and b.bin = i.bin
where st.feature in (select feature from top)"""
MEANS = ", ".join(f"avg({c}) as m_{c}" for c in NUMBERS)


def squared(a: str, b: str) -> str:
    return " + ".join(f"({a}{c} - {b}{c})^2" for c in NUMBERS)


MOMENTS = f"""a as ({ASSIGNED}), m as (select cluster, count(*) as n, {MEANS} from a group by cluster),
g as (select {', '.join(f'avg({c}) as g_{c}' for c in NUMBERS)}, count(*) as n from a)"""
SQL["calinski_harabasz"] = f"""with {MOMENTS},
w as (select sum({squared('a.', 'm.m_')}) as w from a join m on a.cluster = m.cluster),
b as (select sum(m.n * ({squared('m.m_', 'g.g_')})) as b, count(*) as k, max(g.n) as n from m, g)
select {r('(b / (k - 1)) / (w / (n - k))')} as calinski_harabasz from w, b"""
SQL["davies_bouldin"] = f"""with {MOMENTS},
s as (select m.cluster, avg(sqrt({squared('a.', 'm.m_')})) as s from a join m on a.cluster = m.cluster group by m.cluster)
select {r('avg(worst)', 4)} as davies_bouldin from (select m.cluster, max((s.s + s2.s) / sqrt({squared('m.m_', 'q.m_')})) as worst
 from m join m q on m.cluster <> q.cluster join s on s.cluster = m.cluster join s s2 on s2.cluster = q.cluster group by m.cluster)"""
CENTRE_ROWS = "(values (0, 10.0, 20.0), (1, 25.0, 24.0), (2, 40.0, 28.0)) c(i, c0, c1)"
NEAREST = f"""near as (select p_partkey, f0, f1, cast(arg_min(i, d * 10 + i * 1e-12) as int) as cluster from
 (select p_partkey, f0, f1, i, (f0 - c0)^2 + (f1 - c1)^2 as d from ({PARTS}), {CENTRE_ROWS}) group by p_partkey, f0, f1)"""
SQL["kmeans_assign"] = f"with {NEAREST} select p_partkey, cluster from near"
SQL["kmeans_lloyd_step"] = f"with {NEAREST} select cluster, count(*) as n, {r('avg(f0)')} as m0, {r('avg(f1)')} as m1 from near group by cluster"

# --- profile -----------------------------------------------------------------------------------

LINE_NAMES = list(fx.LINE_COLUMNS)
MISSING = union(f"""select '{c}' as "column", count(*) as n_rows, cast(count(*) - count({c}) as bigint) as missing,
 (count(*) - count({c})) / count(*) as fraction from x""" for c in LINE_NAMES)
SQL["profile_missing"] = f'with x as ({LINES}) select "column", n_rows, missing, {r("fraction")} as fraction from ({MISSING})'
SQL["sink_validation_report"] = SQL["profile_missing"]
SQL["validate_nulls"] = f'with x as ({LINES}) select "column", {r("fraction")} as fraction from ({MISSING}) where fraction > 0.05'


def describe(columns, source: str, digits: int = 4) -> str:
    return f"with x as ({source}) " + union(f"""select '{c}' as "column", count({c}) as count, {r(f'avg({c})', digits)} as mean,
 {r(f'stddev_samp({c})', digits)} as std, {r(f'cast(min({c}) as double)', digits)} as min, {r(f'quantile_cont(cast({c} as double), 0.25)', digits)} as q25,
 {r(f'quantile_cont(cast({c} as double), 0.5)', digits)} as q50, {r(f'quantile_cont(cast({c} as double), 0.75)', digits)} as q75,
 {r(f'cast(max({c}) as double)', digits)} as max from x""" for c in columns)


SQL["profile_numeric"] = describe([*fx.LINE_KEY, *NUMBERS], LINES)
SQL["profile_numeric_documents"] = describe(["doc_id", "n_chars"], "select * from documents")
SQL["profile_top_values"] = """select "column", value, n, cast(rank as int) as rank from (
 select *, row_number() over (partition by "column" order by n desc, value) as rank from (""" + union(
    f"""select '{c}' as "column", {c} as value, count(*) as n from documents where {c} is not null group by {c}"""
    for c in ("text", "lang", "source")) + ")) where rank <= 5"


def distribution(column: str, source: str) -> str:
    return f"""select {column} as value, count(*) as n, {r(f'count(*) * 100.0 / (select count(*) from {source})')} as percent,
 'string' as type, cast((select count(distinct {column}) from {source}) as bigint) as "distinct"
 from {source} where {column} is not null group by {column}"""


SQL["target_distribution"] = distribution("event_type", "events")
SQL["export_results"] = f"select value, n, percent from ({distribution('cls', f'({LINES})')})"
SQL["prediction_distribution"] = f"""select y_pred as prediction, count(*) as n,
 {r('count(*) * 100.0 / (select count(*) from lineitem)')} as percent from ({SCORED}) group by y_pred"""
TOTAL = " + ".join(f"({w})" for w in fx.MULTI_WEIGHTS)
P = [f"cast({w} as double) / ({TOTAL})" for w in fx.MULTI_WEIGHTS]
SQL["prediction_confidence"] = f"""select {r('avg(c)')} as mean, {r('quantile_cont(c, 0.5)')} as median, {r('min(c)')} as min,
 {r('max(c)')} as max from (select greatest({', '.join(P)}) as c from lineitem)"""

# --- splits ------------------------------------------------------------------------------------

SQL["train_test_split"] = f"""select {KEY}, case when row_number() over (order by {HASHED_KEY}) <=
 count(*) over () - cast(ceil(0.2 * count(*) over ()) as bigint) then 'train' else 'test' end as split from lineitem"""
SQL["train_test_split_ordered"] = """select event_id, value, case when row_number() over (order by event_id) <=
 count(*) over () - cast(ceil(0.2 * count(*) over ()) as bigint) then 'train' else 'test' end as split from events"""
EVENT_HASH = f"md5({row_digest('event_id')} || '|42')"
SQL["stratified_split"] = f"""with sizes as (select event_type, count(*) as m from events group by event_type),
t as (select sum(m) as n, sum(m) - ceil(0.2 * sum(m)) as total from sizes),
q as (select event_type, floor(total * m / n) as base, round(total * m / n - floor(total * m / n), 9) as rest, total from sizes, t),
quota as (select event_type, base + case when row_number() over (order by rest desc, event_type) <=
 total - sum(base) over () then 1 else 0 end as quota from q)
select event_id, event_type, case when row_number() over (partition by event_type order by {EVENT_HASH}) <= quota
 then 'train' else 'test' end as split from events join quota using (event_type)"""


def plain_folds(source: str, hashed: str) -> str:
    """Contiguous runs of the hash order; the first n mod 5 folds are one row longer."""
    return f"""select *, cast(case when rk < (n % 5) * (n // 5 + 1) then rk // (n // 5 + 1)
 else (n % 5) + (rk - (n % 5) * (n // 5 + 1)) // (n // 5) end as int) as fold
 from (select *, row_number() over (order by {hashed}) - 1 as rk, count(*) over () as n from {source})"""


PART_HASH = f"md5({row_digest('p_partkey')} || '|42')"
SQL["kfold"] = f"select p_partkey, fold from ({plain_folds('part', PART_HASH)})"
SQL["stratified_kfold"] = f"""with o as (select event_id, event_type, row_number() over (order by event_type, event_id) - 1 as pos from events),
alloc as (select event_type, pos % 5 as fold, count(*) as c from o group by 1, 2),
upto as (select event_type, fold, sum(c) over (partition by event_type order by fold) as hi, c from alloc),
rk as (select event_id, event_type, row_number() over (partition by event_type order by {EVENT_HASH}) as rk from events)
select event_id, rk.event_type, cast(fold as int) as fold from rk join upto on rk.event_type = upto.event_type and rk > hi - c and rk <= hi"""
SQL["label_encode"] = "select event_id, event_type, cast(dense_rank() over (order by event_type) - 1 as int) as label from events"
SQL["project_xy"] = f"select * exclude (cls), cls as label from ({LINES})"
SQL["class_weights"] = f"""select quality as label, count(*) as n,
 {r('(select count(*) from labels join documents using (doc_id)) / ((select count(distinct quality) from labels join documents using (doc_id)) * count(*))')}
 as weight from labels join documents using (doc_id) group by quality"""

# --- preprocessing -------------------------------------------------------------------------------

SQL["impute_numeric"] = f"with x as ({LINES}) select {KEY}, coalesce(qty, (select quantile_cont(qty, 0.5) from x)) as qty from x"
FILLS = {
    "median": "(select quantile_cont({c}, 0.5) from x)",
    "mean": "(select avg({c}) from x)",
    "constant": "cast(0 as double)",
    "most_frequent": "(select {c} from x where {c} is not null group by {c} order by count(*) desc, {c} limit 1)",
}
SQL["impute_strategies"] = f"with x as ({LINES}) " + union(
    f"select '{s}' as strategy, '{c}' as \"column\", {r(e.format(c=c))} as fill"
    for c in ("qty", "price", "tax") for s, e in FILLS.items())
SQL["impute_categorical"] = f"""with x as ({LINES}) select {KEY}, coalesce(flag,
 (select flag from x where flag is not null group by flag order by count(*) desc, flag limit 1)) as flag from x"""
FILLED = f"""x as ({LINES}), f as (select {KEY}, {', '.join(f'coalesce({c}, (select quantile_cont({c}, 0.5) from x)) as {c}' for c in NUMBERS)},
 coalesce(flag, (select flag from x where flag is not null group by flag order by count(*) desc, flag limit 1)) as flag, status from x),
z as (select {KEY}, flag, status, {', '.join(f'({c} - avg({c}) over ()) / stddev_pop({c}) over () as z_{c}' for c in NUMBERS)} from f)"""
SQL["scale_standard"] = f"with {FILLED} select {KEY}, {', '.join(f'{r(f"z_{c}")} as z_{c}' for c in NUMBERS)} from z"
SQL["scale_minmax"] = f"""with {FILLED} select {KEY}, {', '.join(
    f'{r(f"({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ())")} as z_{c}' for c in NUMBERS)} from f"""
HOT = ["flag = 'N'", "flag = 'R'", "status = 'O'"]
SQL["one_hot"] = f"""with {FILLED} select {KEY}, cast(flag = 'N' as int) as "flag_N", cast(flag = 'R' as int) as "flag_R",
 cast(status = 'O' as int) as "status_O" from z"""
SQL["assemble_features"] = f"""with {FILLED} select {KEY}, {', '.join(f'{r(f"z_{c}")} as x{i}' for i, c in enumerate(NUMBERS))},
 {', '.join(f'cast({h} as double) as x{i + 4}' for i, h in enumerate(HOT))} from z"""
SQL["feature_names"] = f"""with x as ({LINES}), names as (
 {union(f"select 0 as grp, {i} as sub, '{c}' as name" for i, c in enumerate(NUMBERS))} union all
 select 1, row_number() over (order by flag), 'flag_' || flag from (select distinct flag from x where flag is not null
  and flag > (select min(flag) from x)) union all
 select 2, row_number() over (order by status), 'status_' || status from (select distinct status from x where status > (select min(status) from x)))
select cast(row_number() over (order by grp, sub) - 1 as int) as position, name from names"""
RHO = f"(select corr(price, disc) from ({LINES}))"
SQL["pca_variance"] = f"""with c as (select abs({RHO}) as rho, count(*) as n from lineitem),
v as (select 0 as component, 1 + rho as e, n from c union all select 1, 1 - rho, n from c)
select component, {r('e * n / (n - 1)')} as explained_variance, {r('e / 2')} as ratio,
 {r('sum(e / 2) over (order by component)')} as cumulative from v"""
SQL["pca_project_2d"] = f"""with {FILLED} select {KEY}, {r(f"(z_price + sign({RHO}) * z_disc) / sqrt(2)", 5)} as pc1,
 {r(f"(z_price - sign({RHO}) * z_disc) / sqrt(2)", 5)} as pc2 from z"""
SQL["cluster_scatter_2d"] = f"""with a as ({ASSIGNED}),
z as (select cluster, (price - avg(price) over ()) / stddev_pop(price) over () as z1, (disc - avg(disc) over ()) / stddev_pop(disc) over () as z2 from a),
s as (select sign(corr(price, disc)) as s from a)
select {r('(z1 + s * z2) / sqrt(2)', 5)} as pc1, {r('(z1 - s * z2) / sqrt(2)', 5)} as pc2, cluster from z, s"""
SQL["truncated_svd"] = f"""with {FILLED}, x2 as (select *, case when status = 'O' then 1.0 else 0.0 end as o from z),
g as (select sum(z_price * z_price) as a, sum(o) as b, sum(z_price * o) as c from x2),
l as (select *, ((a + b) + sqrt((a - b)^2 + 4 * c * c)) / 2 as top from g),
v as (select (top - b) / sqrt((top - b)^2 + c * c) as v1, c / sqrt((top - b)^2 + c * c) as v2 from l)
select {KEY}, {r('abs(z_price * v1 + o * v2)')} as component_0 from x2, v"""

# --- models --------------------------------------------------------------------------------------

RIDGE = """z as (select p_partkey, p_retailprice as y, (p_partkey - avg(p_partkey) over ()) / stddev_pop(p_partkey) over () as x from part),
f as (select sum(x * (y - ym)) / (sum(x * x) + 1) as w, max(ym) as b from (select *, avg(y) over () as ym from z))"""
SQL["ridge_regression"] = f"""with {RIDGE} select 'p_partkey' as feature, {r('w')} as value from f union all
 select '(intercept)', {r('b')} from f"""
SQL["save_load_model"] = f"with {RIDGE} select p_partkey, {r('b + w * x')} as prediction from z, f"
SQL["evaluation_report"] = f"""with {RIDGE}, e as (select y, b + w * x as p from z, f),
s as (select avg((y - p)^2) as mse, avg(abs(y - p)) as mae, var_pop(y) as v, avg(abs((y - p) / y)) * 100 as mape from e)
select 'metric' as section, 'ridge' as item, u.metric, round(u.value, 4) + 0.0 as value from s,
 lateral (values ('mse', mse), ('rmse', sqrt(mse)), ('mae', mae), ('r2', 1 - mse / v), ('mape', mape)) u(metric, value)"""


def stump(label: str, score: str) -> str:
    """The best single threshold on quantity by total squared error of the two sides."""
    return f"""with x as (select l_quantity as q, {label} as y from lineitem),
t as (select distinct q as cut from x), lim as (select max(q) as top from x),
s as (select cut, sum((q <= cut)::int) as nl, sum((q > cut)::int) as nr, sum(case when q <= cut then y else 0 end) as sl,
 sum(case when q > cut then y else 0 end) as sr from x, t, lim where cut < top group by cut),
best as (select cut from s order by sl * sl / nl + sr * sr / nr desc limit 1)
select {score} as {{name}}, count(*) as n, min(q) as low, max(q) as high from x, best group by q <= cut"""


SQL["decision_tree_classifier"] = stump(f"cast({fx.LINE_COLUMNS['cls']} = 'yes' as double)", r("avg(y)")).format(name="p_yes")
SQL["decision_tree_regressor"] = stump("l_extendedprice", r("avg(y)", 4)).format(name="prediction")


SQL["random_forest_single_tree"] = SQL["decision_tree_regressor"]
XY = "select p_partkey, cast(p_partkey as double) as x, p_retailprice as y from part"


def ridge_cv(alphas, source: str = f"({XY})") -> str:
    """Per-fold ridge on one feature standardised with the statistics of the other folds."""
    parts = plain_folds(source, PART_HASH)
    return f"""base as ({parts}),
alpha as (select unnest([{', '.join(f'cast({a} as double)' for a in alphas)}]) as alpha),
h as (select unnest(range(5)) as held),
tr as (select held, avg(x) as mx, stddev_pop(x) as sx, avg(y) as my, count(*) as n from base, h where fold <> held group by held),
w as (select tr.held, alpha, sum((x - mx) / sx * (y - my)) / (max(tr.n) + alpha) as w from base join tr on base.fold <> tr.held, alpha
 group by tr.held, alpha),
p as (select tr.held as fold, w.alpha, case when base.fold = tr.held then 'test' else 'train' end as part, y, my + w * (x - mx) / sx as p
 from base, tr join w on w.held = tr.held),
m as (select fold, alpha, part, sqrt(avg((y - p)^2)) as rmse, 1 - avg((y - p)^2) / var_pop(y) as r2 from p group by 1, 2, 3),
sc as (select alpha, cast(fold as int) as fold, part, 'neg_root_mean_squared_error' as metric, -rmse as score from m union all
 select alpha, cast(fold as int), part, 'r2', r2 from m)"""


SQL["cross_validate"] = f"with {ridge_cv([1])} select 'ridge' as candidate, fold, part, metric, {r('score')} as score from sc"
SQL["cv_summary"] = f"""with {ridge_cv([1])} select 'ridge' as candidate, part, metric, {r('avg(score)')} as mean,
 {r('stddev_pop(score)')} as std from sc group by part, metric"""
SQL["model_comparison"] = f"""with {ridge_cv([1, 100, 10000])} select 'ridge_' || cast(alpha as int) as candidate,
 {r("avg(case when metric = 'neg_root_mean_squared_error' then score end)")} as neg_root_mean_squared_error,
 {r("avg(case when metric = 'r2' then score end)")} as r2, {r("stddev_pop(case when metric = 'r2' then score end)")} as r2_std
 from sc where part = 'test' group by alpha"""

SQL["search_ranking"] = f"""with {ridge_cv([1, 100, 10000])}, rk as (select alpha,
 avg(score) filter (part = 'test') as mean_test, stddev_pop(score) filter (part = 'test') as std_test,
 avg(score) filter (part = 'train') as mean_train, stddev_pop(score) filter (part = 'train') as std_train
 from sc where metric = 'r2' group by alpha)
select 'ridge_' || cast(alpha as int) as candidate, {r('mean_test')} as mean_test, {r('std_test')} as std_test,
 {r('mean_train')} as mean_train, {r('std_train')} as std_train, cast(rank() over (order by mean_test desc) as int) as rank from rk"""
SQL["learning_curve"] = f"""with {ridge_cv([1, 100, 10000])} select cast(alpha as varchar) as value,
 {r("avg(score) filter (part = 'train')")} as train_score, {r("avg(score) filter (part = 'test')")} as test_score
 from sc where metric = 'r2' group by alpha"""

# --- evaluation ----------------------------------------------------------------------------------

SQL["confusion_matrix"] = f"""with x as ({SCORED}), l as (select distinct y_true as v from x union select distinct y_pred from x)
select a.v as y_true, b.v as y_pred, (select count(*) from x where x.y_true = a.v and x.y_pred = b.v) as n from l a, l b"""
PER_CLASS = f"""x as ({SCORED}), l as (select distinct y_true as label from x union select distinct y_pred from x),
c as (select label, count(*) filter (y_true = label and y_pred = label) as tp, count(*) filter (y_true = label) as support,
 count(*) filter (y_pred = label) as predicted from x, l group by label),
s as (select *, case when predicted > 0 then tp / predicted else 0 end as p, case when support > 0 then tp / support else 0 end as r,
 case when support + predicted > 0 then 2 * tp / (support + predicted) else 0 end as f from c)"""
SQL["classification_report"] = f"""with {PER_CLASS}
select cast(label as varchar) as label, {r('p')} as precision, {r('r')} as recall, {r('f')} as f1, support from s union all
select 'accuracy', {r('sum(tp) / sum(support)')}, {r('sum(tp) / sum(support)')}, {r('sum(tp) / sum(support)')}, cast(sum(support) as bigint) from s union all
select 'macro avg', {r('avg(p)')}, {r('avg(r)')}, {r('avg(f)')}, cast(sum(support) as bigint) from s union all
select 'weighted avg', {r('sum(p * support) / sum(support)')}, {r('sum(r * support) / sum(support)')},
 {r('sum(f * support) / sum(support)')}, cast(sum(support) as bigint) from s"""
SQL["balanced_accuracy"] = f"with {PER_CLASS} select {r('avg(r)')} as balanced_accuracy from s where support > 0"
SQL["f1_weighted"] = f"with {PER_CLASS} select {r('sum(f * support) / sum(support)')} as f1_weighted from s"
SQL["f1_binary"] = f"with {PER_CLASS} select {r('f')} as f1 from s where label = 1"


def auc(source: str) -> str:
    """Rank-sum form, per class: ties share their mean rank."""
    return f"""select class, sum(hit) as p, (sum(case when hit = 1 then rk else 0 end) - sum(hit) * (sum(hit) + 1) / 2.0)
 / (sum(hit) * sum(1 - hit)) as auc from (select class, hit, rank() over (partition by class order by score)
 + (count(*) over (partition by class, score) - 1) / 2.0 as rk from ({source})) group by class"""


SQL["roc_auc"] = f"""select {r('auc', 8)} as roc_auc, cast(p as bigint) as n_pos, (select count(*) from lineitem) - cast(p as bigint) as n_neg
 from ({auc(f'select 1 as class, y_true as hit, score from ({SCORED})')})"""
OVR = union(f"select {i} as class, cast(({fx.MULTI_LABEL}) = {i} as int) as hit, {p} as score from lineitem" for i, p in enumerate(P))
SQL["roc_auc_ovr_weighted"] = f"select {r('sum(auc * p) / sum(p)', 8)} as roc_auc from ({auc(OVR)})"


def ranked(source: str) -> str:
    return f"""g as (select score, sum(y_true) as pos, count(*) - sum(y_true) as neg from ({source}) group by score),
k as (select score, pos, neg, sum(pos) over o as tp, sum(neg) over o as fp, sum(pos) over () as p, sum(neg) over () as n,
 lead(pos) over o as npos, lead(neg) over o as nneg, row_number() over o as i from g window o as (order by score desc))"""


def roc(source: str) -> str:
    return f"""with {ranked(source)} select cast(null as double) as threshold, 0.0::double as fpr, 0.0::double as tpr union all
select {r('score')}, {r('fp / n')}, {r('tp / p')} from k where i = 1 or npos is null or npos <> pos or nneg <> neg"""


SQL["average_precision"] = f"with {ranked(SCORED)} select {r('sum(pos / p * tp / (tp + fp))', 8)} as average_precision from k"
SQL["roc_curve"] = roc(SCORED)
SQL["roc_curve_many_scores"] = roc("select case when l_returnflag = 'R' then 1 else 0 end as y_true, l_extendedprice as score from lineitem")
SQL["pr_curve"] = f"""with {ranked(SCORED)} select {r('score')} as threshold, {r('tp / (tp + fp)')} as precision, {r('tp / p')} as recall from k
union all select null, 1.0, 0.0"""
SQL["regression_metrics"] = f"""select {r('avg((y_true - y_pred)^2)')} as mse, {r('sqrt(avg((y_true - y_pred)^2))')} as rmse,
 {r('avg(abs(y_true - y_pred))')} as mae, {r('1 - sum((y_true - y_pred)^2) / (var_pop(y_true) * count(*))')} as r2 from ({REGRESSION})"""
SQL["mape"] = f"""select 'as_is' as copy, {r('avg(abs((y_true - y_pred) / y_true)) * 100')} as mape from ({REGRESSION})
union all select 'with_zero', null"""
SQL["residuals"] = f"select {r('y_true')} as y_true, {r('y_pred')} as y_pred, {r('y_true - y_pred')} as residual from ({REGRESSION})"
SQL["residual_histogram"] = f"""with e as (select y_true - y_pred as v from ({REGRESSION})),
s as (select min(v) as lo, (max(v) - min(v)) / 50 as w from e),
b as (select least(cast(floor((v - lo) / w) as int), 49) as bin, count(*) as n from e, s group by 1)
select cast(i.bin as int) as bin, {r('lo + i.bin * w', 4)} as low, {r('lo + (i.bin + 1) * w', 4)} as high, coalesce(b.n, 0) as n
from (select unnest(range(50)) as bin) i, s left join b on b.bin = i.bin"""

# --- jobs ----------------------------------------------------------------------------------------

LINE_TYPES = {**dict.fromkeys(fx.LINE_KEY, "bigint"), "l_linenumber": "int", **dict.fromkeys(NUMBERS, "double"),
              **dict.fromkeys(("flag", "status", "cls"), "string")}
SQL["job_data_summary"] = f"""with x as ({LINES}), m as ({MISSING})
select 'shape' as section, 'rows' as item, 'count' as metric, cast(count(*) as double) as value from x union all
select 'shape', 'columns', 'count', {len(LINE_NAMES)} union all
select 'schema', 'valid', 'flag', 0 union all
select 'nulls', 'valid', 'flag', case when max(fraction) > 0.05 then 0 else 1 end from m union all
select 'schema', 'discount', 'missing', 1 union all
select 'schema', "column", 'extra', 1 from m where "column" not in ('qty', 'price', 'flag') union all
select 'nulls', "column", 'fraction', {r('fraction')} from m where fraction > 0.05 union all
select 'missing', "column", 'count', missing from m union all
select 'missing', "column", 'percent', {r('fraction * 100')} from m union all
select 'target', cls, 'percent', {r('count(*) * 100.0 / (select count(*) from x)')} from x group by cls union all
select 'type', name, kind, 1 from (values {', '.join(f"('{n}', '{k}')" for n, k in LINE_TYPES.items())}) v(name, kind) union all
select 'numeric', "column", u.metric, u.value from ({describe([*fx.LINE_KEY, *NUMBERS], LINES)}),
 lateral (values {', '.join(f"('{c}', cast({c} as double))" for c in ('"count"', 'mean', 'std', '"min"', 'q25', 'q50', 'q75', '"max"')).replace("'" + '"', "'").replace('"' + "'", "'")}) u(metric, value) union all
select 'top_values', "column", rank || ':' || value, n from (
 select *, row_number() over (partition by "column" order by n desc, value) as rank from (""" + union(
    f"""select '{c}' as "column", {c} as value, count(*) as n from ({LINES}) where {c} is not null group by {c}"""
    for c in ("flag", "status", "cls")) + ")) where rank <= 5"

# split, fold the training rows, cross-validate, refit on the training rows, score the test rows
TRAIN = f"""parts as (select *, row_number() over (order by {PART_HASH}) <= count(*) over () - cast(ceil(0.2 * count(*) over ()) as bigint)
 as is_train from ({XY}))"""
SQL["job_train_regression"] = f"""with {TRAIN}, {ridge_cv([1], '(select p_partkey, x, y from parts where is_train)')},
cv as (select metric, avg(score) as mean, stddev_pop(score) as std from sc where part = 'test' group by metric),
st as (select avg(x) as mx, stddev_pop(x) as sx, avg(y) as my from parts where is_train),
fit as (select sum((x - mx) / sx * (y - my)) / (count(*) + 1) as w, max(mx) as mx, max(sx) as sx, max(my) as my from parts, st where is_train),
e as (select y, my + w * (x - mx) / sx as p from parts, fit where not is_train),
v as (select avg((y - p)^2) as mse, avg(abs(y - p)) as mae, var_pop(y) as v, avg(abs((y - p) / y)) * 100 as mape from e)
select 'cross_validation' as section, 'baseline' as item, metric || '_mean' as metric, {r('mean', 4)} as value from cv union all
select 'cross_validation', 'baseline', metric || '_std', {r('std', 4)} from cv union all
select 'metric', 'baseline', u.metric, round(u.value, 4) + 0.0 from v,
 lateral (values ('mse', mse), ('rmse', sqrt(mse)), ('mae', mae), ('r2', 1 - mse / v), ('mape', mape)) u(metric, value)"""

# --- models with a known optimum ---------------------------------------------------------------

SQL["logistic_multiclass_cells"] = f"""with e as (select concat('u', user_id % 3) as cell, event_type from events),
c as (select event_type, row_number() over (order by event_type) - 1 as class from (select distinct event_type from e)),
n as (select cell, count(*) as n from e group by cell)
select n.cell, cast(c.class as int) as class, n.n, {r('count(e.event_type) / n.n', 3)} as rate
from n cross join c left join e on e.cell = n.cell and e.event_type = c.event_type group by n.cell, c.class, n.n"""
SQL["logistic_cells"] = f"""with e as (select status || coalesce(flag, '-') as cell, cls from ({LINES}))
select cell, k.class, count(*) as n, {r("avg(case when (cls = 'yes') = (k.class = 1) then 1.0 else 0.0 end)", 3)} as rate
from e, (values (0), (1)) k(class) group by cell, k.class"""
SQL["random_forest_stumps"] = f"""with x as (select l_quantity as q, case when l_quantity * 2000 > l_extendedprice then 1 else 0 end as y from lineitem),
t as (select distinct q as cut from x), lim as (select max(q) as top from x),
g as (select cut, sum(case when q <= cut then 1 else 0 end) as nl, sum(case when q <= cut then y else 0 end) as yl, count(*) as n, sum(y) as ys
 from x, t, lim where cut < top group by cut),
best as (select cut from g order by nl * (2 * (yl / nl) * (1 - yl / nl)) + (n - nl) * (2 * ((ys - yl) / (n - nl)) * (1 - (ys - yl) / (n - nl))), cut limit 1)
select {r('avg(y)')} as p_yes, count(*) as n, min(q) as low, max(q) as high from x, best group by q <= cut"""
SQL["feature_importance_stumps"] = "select * from (values ('l_quantity', 1.0), ('nothing', 0.0)) v(feature, importance)"
SQL["kmeans_two_of_one_feature"] = f"""with x as (select cast(p_size * p_size as double) as v from part),
t as (select distinct v as cut from x), lim as (select max(v) as top from x),
w as (select cut, sum(case when v <= cut then 0 else 1 end) * var_pop(case when v > cut then v end)
 + sum(case when v <= cut then 1 else 0 end) * var_pop(case when v <= cut then v end) as sse from x, t, lim where cut < top group by cut),
best as (select cut from w order by sse limit 1)
select count(*) as n, min(v) as low, max(v) as high from x, best group by v <= cut"""

# the training rows of a split by key, their best threshold, and what follows from it
TWO = f"""s as (select cast(p_size * p_size as double) as v, row_number() over (order by md5({row_digest('p_partkey')} || '|42')) as i, count(*) over () as n from part),
x as (select v from s where i <= n - cast(ceil(0.2 * n) as bigint)), t as (select distinct v as cut from x), lim as (select max(v) as top from x),
w as (select cut, sum(case when v <= cut then 0 else 1 end) * var_pop(case when v > cut then v end)
 + sum(case when v <= cut then 1 else 0 end) * var_pop(case when v <= cut then v end) as sse from x, t, lim where cut < top group by cut),
best as (select cut from w order by sse limit 1), c as (select v, v <= cut as c from x, best),
whole as (select avg(v) as mean, stddev_pop(v) as scale, count(*) as rows from x)"""
SQL["cluster_job_profile_two"] = f"""with {TWO}
select count(*) as size, {r('count(*) * 100.0 / max(rows)', 4)} as percent, 'x' as feature, {r('avg(v)', 4)} as mean, {r('stddev_samp(v)', 4)} as std, {r('min(v)', 4)} as min, {r('max(v)', 4)} as max
from c, whole group by c"""
SQL["job_cluster_two"] = f"""with {TWO},
z as (select (v - mean) / scale as z, c, rows from c, whole), m as (select c, count(*) as n, avg(z) as m, var_pop(z) as var, avg(abs(z - k)) as apart
 from (select z, c, avg(z) over (partition by c) as k from z) group by c),
pair as (select p.n + q.n as rows, p.n * p.var + q.n * q.var as within, p.n * p.m * p.m + q.n * q.m * q.m as between, (p.apart + q.apart) / abs(p.m - q.m) as db from m p, m q where p.c and not q.c),
own as (select z, (pow(z - p.m, 2) + p.var) * p.n / (p.n - 1) as a, pow(z - q.m, 2) + q.var as b from z join m p on p.c = z.c join m q on q.c <> z.c),
shape as (select avg((b - a) / greatest(a, b)) as silhouette from own)
select 'clustering' as section, 'silhouette' as item, 'best_k' as metric, 2.0 as value union all
select 'k_table', '2', 'inertia', {r('within', 4)} from pair union all select 'k_table', '2', 'silhouette', {r('silhouette', 4)} from shape union all
select 'k_table', '2', 'calinski_harabasz', {r('between / (within / (rows - 2))', 4)} from pair union all select 'k_table', '2', 'davies_bouldin', {r('db', 4)} from pair"""
