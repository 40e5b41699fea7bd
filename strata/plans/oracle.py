"""DuckDB SQL twins of the views and operators, used as the correctness oracle.

The strings are built from the same fixed column lists as the Spark views so
the two sides cannot drift.  Doubles are rounded to ``PLACES`` on both sides.
"""

from __future__ import annotations

from strata.plans.views import (DAY_BIG_CLICK, DAY_EVENT_TYPES, DAY_SPEC, ORD_MEASURES,
                                ORD_SPEC)
from strata.spec import CohortSpec

PLACES = 6


def r(expr: str, places: int = PLACES) -> str:
    return f"round(CAST({expr} AS DOUBLE), {places})"


V_ORD_RAW = f"""v_ord_raw AS (
  SELECT l.l_orderkey, l.l_linenumber, {', '.join('l.' + m for m in ORD_MEASURES)},
         o.o_totalprice, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS o_priority,
         CAST(l.l_returnflag = 'R' AND l.l_quantity >= 40 AND l.l_discount >= 0.08 AS INTEGER) AS is_pos
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_orderkey IS NOT NULL)"""

_types = ", ".join(
    f"avg(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in DAY_EVENT_TYPES)
V_DAY_RAW = f"""v_day_raw AS (
  SELECT user_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hr, {_types},
         avg(CASE WHEN event_type = 'click' AND value > {DAY_BIG_CLICK} THEN value END) AS click_big,
         max(CAST(event_type = 'error' AS INTEGER)) AS is_pos, 1.0::DOUBLE AS const_one
  FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2, 3)"""

V_SCORE = """v_score AS (
  SELECT l_orderkey, label,
         round(least(1.0, greatest(0.0, 0.5 * mq / 50 + 5 * md - 0.35)), 2) AS p,
         round(0.5 * mq / 50, 2) AS p2
  FROM (SELECT l_orderkey, max(l_quantity) AS mq, max(l_discount) AS md, max(is_pos) AS label
        FROM v_ord_raw GROUP BY l_orderkey))"""

V_SCORES_LONG = """v_scores_long AS (
  SELECT 'forest' AS model, l_orderkey, label, p FROM v_score
  UNION ALL SELECT 'boosted' AS model, l_orderkey, label, p2 AS p FROM v_score)"""

_AGG_SQL = {"min": "min", "max": "max", "mean": "avg", "std": "stddev_samp"}


def entity_select(spec: CohortSpec, src: str, rounded: bool = True) -> str:
    """SELECT producing the entity table of ``spec`` from ``src``."""
    rr = r if rounded else (lambda e: f"CAST({e} AS DOUBLE)")
    cols = list(spec.entity)
    for s in spec.statics:
        cols.append(f"min({{'o': {spec.seq}, 'v': {s}}}) FILTER (WHERE {s} IS NOT NULL).v AS {s}")
    for m in spec.measures:
        for a in spec.aggs:
            cols.append(f"{rr(f'{_AGG_SQL[a]}({m})')} AS {m}_{a}")
    for m in spec.measures:
        cols.append(f"{rr(f'max({m}) - min({m})')} AS {m}_range")
    cols.append(f"max({spec.seq}) AS {spec.length_col}")
    cols.append(f"max(CAST({spec.row_label} AS INTEGER)) AS {spec.target}")
    return f"SELECT {', '.join(cols)} FROM {src} GROUP BY {', '.join(spec.entity)}"


ORD_ENT = f"ord_ent AS ({entity_select(ORD_SPEC, 'v_ord_raw', rounded=False)})"
DAY_ENT = f"day_ent AS ({entity_select(DAY_SPEC, 'v_day_raw', rounded=False)})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- sampling twins (md5 draw order, largest-remainder quotas) -------------
def draw_sql(keys: list[str], seed: int) -> str:
    return "md5('" + str(seed) + "' || " + " || ".join(
        f"':' || CAST({k} AS VARCHAR)" for k in keys) + ")"


def split_sql(name: str, src: str, keys: list[str], label: str, share, seed: int,
              names: tuple[str, str]) -> str:
    """CTEs ``{name}_*`` ending in ``{name}`` = src.* + split."""
    if isinstance(share, int):
        n_test = f"CAST({share} AS BIGINT)"
    else:
        n_test = f"CAST(ceil({float(share)}::DOUBLE * sum(n_c)) AS BIGINT)"
    k = ", ".join(keys)
    return f"""{name}_cnt AS (SELECT {label}, count(*) AS n_c FROM {src} GROUP BY {label}),
{name}_tot AS (SELECT sum(n_c) AS n, {n_test} AS n_test FROM {name}_cnt),
{name}_q AS (SELECT c.{label}, CAST(c.n_c AS DOUBLE) / t.n * (t.n - t.n_test) AS cont,
                    t.n - t.n_test AS n_train FROM {name}_cnt c, {name}_tot t),
{name}_q2 AS (SELECT {label}, floor(cont) AS fl, n_train,
                     row_number() OVER (ORDER BY cont - floor(cont) DESC, {label}) AS rr,
                     sum(floor(cont)) OVER () AS sfl FROM {name}_q),
{name}_quota AS (SELECT {label}, CAST(fl + CASE WHEN rr <= n_train - sfl THEN 1 ELSE 0 END AS BIGINT)
                        AS quota FROM {name}_q2),
{name}_rk AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {draw_sql(keys, seed)}, {k})
                     AS rn FROM {src}),
{name} AS (SELECT r.* EXCLUDE (rn), CASE WHEN r.rn <= q.quota THEN '{names[0]}' ELSE '{names[1]}' END
                  AS split FROM {name}_rk r JOIN {name}_quota q ON r.{label} = q.{label})"""


def folds_sql(name: str, src: str, keys: list[str], label: str, k: int, seed: int) -> str:
    kk = ", ".join(keys)
    return f"""{name}_cnt AS (SELECT {label}, count(*) AS n_c FROM {src} GROUP BY {label}),
{name}_off AS (SELECT {label}, coalesce(sum(n_c) OVER (ORDER BY {label}
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM {name}_cnt),
{name}_rk AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {draw_sql(keys, seed)}, {kk})
                     AS rn FROM {src}),
{name} AS (SELECT r.* EXCLUDE (rn), CAST((o.off + r.rn - 1) % {k} AS INTEGER) AS fold
           FROM {name}_rk r JOIN {name}_off o ON r.{label} = o.{label})"""


ORD_LAB = "ord_lab AS (SELECT l_orderkey, max(is_pos) AS label FROM v_ord_raw GROUP BY 1)"
ORD_SPLIT = split_sql("ord_split", "ord_lab", ["l_orderkey"], "label", 0.2, 42, ("train", "test"))


def long_sql(src: str, ids: list[str], features: list[str]) -> str:
    """Unpivot ``features`` of ``src`` (NULLs kept) into (ids, feature, value)."""
    names = ", ".join(f"'{f}'" for f in features)
    vals = ", ".join(f"CAST({f} AS DOUBLE)" for f in features)
    idc = "".join(f"{i}, " for i in ids)
    return f"SELECT {idc}unnest([{names}]) AS feature, unnest([{vals}]) AS value FROM {src}"


ORD_FEATURES = ORD_SPEC.feature_columns()
DAY_FEATURES = DAY_SPEC.feature_columns()
ORD_MEAN_FEATURES = [f"{m}_mean" for m in ORD_SPEC.measures]
DAY_MEAN_FEATURES = [f"{m}_mean" for m in DAY_SPEC.measures]
DAY_LONG = f"day_long AS ({long_sql('day_ent', ['label'], DAY_FEATURES)})"
ORD_LONG = f"ord_long AS ({long_sql('ord_ent', ['l_orderkey', 'label'], ORD_FEATURES)})"


DAY_SPLIT = split_sql("day_split", "day_ent", ["user_id", "day"], "label", 0.2, 42, ("train", "test"))
DAY_PREP = (
    "dtr AS (SELECT * FROM day_split WHERE split = 'train')",
    f"dtr_long AS ({long_sql('dtr', [], DAY_FEATURES)})",
    f"dall_long AS ({long_sql('day_split', ['user_id', 'day', 'split'], DAY_FEATURES)})",
    "zv AS (SELECT feature FROM dtr_long GROUP BY feature HAVING count(value) >= 2 AND min(value) = max(value))",
    "hn AS (SELECT feature FROM dtr_long WHERE feature NOT IN (SELECT feature FROM zv) GROUP BY feature"
    " HAVING 1.0 - CAST(count(value) AS DOUBLE) / count(*) > 0.9)",
    "med AS (SELECT feature, quantile_cont(value, 0.5) AS med FROM dtr_long WHERE feature NOT IN (SELECT"
    " feature FROM zv) AND feature NOT IN (SELECT feature FROM hn) GROUP BY feature)",
    "imp AS (SELECT a.user_id, a.day, a.split, a.feature, coalesce(a.value, m.med) AS value FROM dall_long a"
    " JOIN med m USING (feature))",
    "kept AS (SELECT feature FROM imp WHERE split = 'train' GROUP BY feature HAVING var_pop(value) > 0.01)",
    "sst AS (SELECT feature, avg(value) AS mu, CASE WHEN stddev_pop(value) IS NULL OR stddev_pop(value) = 0"
    " THEN 1.0 ELSE stddev_pop(value) END AS sc FROM imp WHERE split = 'train' AND feature IN (SELECT feature"
    " FROM kept) GROUP BY feature)",
    "zs AS (SELECT i.user_id, i.day, i.split, i.feature, (i.value - s.mu) / s.sc AS value FROM imp i JOIN sst s"
    " USING (feature))")

ORD_SIGNALS = [
    # Display name, unit and group of each V-ORD signal.
    ("l_quantity", "Quantity", "units", "volume"),
    ("l_extendedprice", "Extended price", "currency", "value"),
    ("l_discount", "Discount", "fraction", "pricing"),
    ("l_tax", "Tax", "fraction", "pricing"),
]
