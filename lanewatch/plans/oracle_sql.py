"""ANSI SQL (DuckDB dialect) for the independent correctness oracle.

The SQL is written separately from the DataFrame code: it restates the same
semantics over the pre-registered table views so the two engines can be
compared row by row.  Fragments are composed as CTEs.
"""

from __future__ import annotations

from lanewatch import constants as K
from lanewatch.sources.proxy import MOTIVE_OF_PRIORITY, OCCURRENCE_OF_STATUS, OUTCOME_OF_LINENUMBER


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(
        f"WHEN {q(k) if isinstance(k, str) else k} THEN {q(v) if isinstance(v, str) else v}"
        for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def safe_div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"


def clip(x: str, lo=None, hi=None) -> str:
    out = x
    if lo is not None:
        out = f"(CASE WHEN ({out}) < {lo} THEN {float(lo)} ELSE ({out}) END)"
    if hi is not None:
        out = f"(CASE WHEN ({out}) > {hi} THEN {float(hi)} ELSE ({out}) END)"
    return out


def _base(alarms: bool) -> str:
    flag = "l.l_returnflag = 'R'" if alarms else "l.l_returnflag <> 'R'"
    return f"""
  SELECT l.l_orderkey * 16 + l.l_linenumber AS _rid,
         upper(ns.n_name) AS AREOPORTO_PARTENZA, upper(nc.n_name) AS AREOPORTO_ARRIVO,
         upper(ns.n_name) || '-' || upper(nc.n_name) AS ROTTA,
         ns.n_name AS PAESE_PART, nc.n_name AS PAESE_ARR, CAST(ns.n_regionkey AS INTEGER) AS ZONA,
         l.l_shipdate AS DATA_PARTENZA, year(l.l_shipdate) AS ANNO_PARTENZA,
         month(l.l_shipdate) AS MESE_PARTENZA,
         l.l_quantity, l.l_discount, l.l_tax, l.l_linenumber, l.l_linestatus,
         o.o_orderstatus, o.o_orderpriority, c.c_mktsegment, s.s_name, nc.n_name AS nc_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  WHERE {flag}"""


def alarms_cte() -> str:
    return f"""alarms AS (
  SELECT _rid, AREOPORTO_PARTENZA, AREOPORTO_ARRIVO, ROTTA, PAESE_PART, PAESE_ARR, ZONA,
         DATA_PARTENZA, ANNO_PARTENZA, MESE_PARTENZA, l_quantity AS TOT,
         {case_map('o_orderpriority', MOTIVE_OF_PRIORITY)} AS MOTIVO_ALLARME,
         {case_map('o_orderstatus || l_linestatus', OCCURRENCE_OF_STATUS)} AS OCCORRENZE
  FROM ({_base(True)}) b)"""


def travellers_cte() -> str:
    inv = "CAST(floor(l_quantity * l_discount * 10) AS DOUBLE)"
    allr = "CAST(floor(l_quantity * l_tax * 5) AS DOUBLE)"
    return f"""travellers AS (
  SELECT _rid, AREOPORTO_PARTENZA, AREOPORTO_ARRIVO, ROTTA, PAESE_PART, PAESE_ARR, ZONA,
         DATA_PARTENZA, ANNO_PARTENZA, MESE_PARTENZA,
         l_quantity AS ENTRATI, {inv} AS INVESTIGATI, {allr} AS ALLARMATI,
         {case_map('l_linenumber', OUTCOME_OF_LINENUMBER, "'OK'")} AS ESITO_CONTROLLO,
         l_linestatus AS GENERE, o_orderpriority AS FASCIA_ETA, c_mktsegment AS TIPO_DOCUMENTO,
         nc_name AS NAZIONALITA, s_name AS COMPAGNIA_AEREA,
         {safe_div(allr, 'l_quantity')} AS tasso_allarme,
         {safe_div(inv, 'l_quantity')} AS tasso_investigati
  FROM ({_base(False)}) b)"""


def _mode(col: str, src: str, key: str = "ROTTA") -> str:
    """Deterministic mode per key: most frequent non-null, ties -> smallest."""
    return f"""(SELECT {key}, {col} AS v FROM (
      SELECT {key}, {col}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {col} ASC) AS rn
      FROM {src} WHERE {col} IS NOT NULL AND {key} IS NOT NULL GROUP BY {key}, {col}) WHERE rn = 1)"""


def alarm_agg_cte() -> str:
    occ = ",\n    ".join(
        f"{clip(f'coalesce(sum(CASE WHEN OCCORRENZE = {q(v)} THEN TOT END), 0.0)', lo=0)} AS {name}"
        for v, name in K.OCCURRENCE_COLUMNS.items())
    mot = ",\n    ".join(
        f"{clip(safe_div(f'CAST(count_if(MOTIVO_ALLARME = {q(m)}) AS DOUBLE)', 'count(MOTIVO_ALLARME)'), 0, 1)} AS pct_{m.lower()}"
        for m in K.MOTIVES)
    return f"""agg_a0 AS (
  SELECT ROTTA,
    arg_min(ZONA, _rid) FILTER (WHERE ZONA IS NOT NULL) AS ZONA,
    arg_min(PAESE_PART, _rid) FILTER (WHERE PAESE_PART IS NOT NULL) AS PAESE_PART,
    count(TOT) AS n_osservazioni_allarmi,
    coalesce(sum(TOT), 0.0) AS tot_allarmi_sum,
    ln(1 + coalesce(sum(TOT), 0.0)) AS tot_allarmi_log,
    {occ},
    {mot}
  FROM alarms WHERE ROTTA IS NOT NULL GROUP BY ROTTA),
agg_a AS (
  SELECT *,
    {clip(safe_div('allarmi_chiusi', 'allarmi_chiusi + allarmi_non_chiusi'), 0, 1)} AS tasso_chiusura,
    {clip(safe_div('allarmi_rilevanti', 'voli_con_allarmi'), 0, 1)} AS tasso_rilevanza,
    {clip(safe_div('np_sdi + np_nsis + np_int', 'allarmi_sdi_occ + allarmi_interpol_occ'), 0, 1)} AS false_positive_rate
  FROM agg_a0)"""


def traveller_agg_cte() -> str:
    outc = ",\n    ".join(f"count_if(ESITO_CONTROLLO = {q(v)}) AS {name}" for v, name in K.OUTCOME_COLUMNS.items())
    modes = {"genere_predominante": "GENERE", "fascia_eta_predominante": "FASCIA_ETA",
             "tipo_doc_prevalente": "TIPO_DOCUMENTO", "nazionalita_top": "NAZIONALITA",
             "compagnia_top": "COMPAGNIA_AEREA", "_paese_fallback": "PAESE_PART",
             "_zona_fallback": "ZONA"}
    mode_joins = "\n  ".join(
        f"LEFT JOIN {_mode(src, 'travellers')} m_{alias} ON m_{alias}.ROTTA = g.ROTTA"
        for alias, src in modes.items())
    mode_cols = ",\n    ".join(
        (f"coalesce(m_{alias}.v, 'ND') AS {alias}" if not alias.startswith("_") else f"m_{alias}.v AS {alias}")
        for alias in modes)
    rej = clip(safe_div("CAST(n_respinti AS DOUBLE)", "n_osservazioni_viag"), 0, 1)
    det = clip(safe_div("CAST(n_fermati AS DOUBLE)", "n_osservazioni_viag"), 0, 1)
    return f"""agg_t0 AS (
  SELECT ROTTA,
    {clip('coalesce(sum(ENTRATI), 0.0)', lo=0)} AS tot_entrati,
    {clip('coalesce(sum(ALLARMATI), 0.0)', lo=0)} AS tot_allarmati,
    {clip('coalesce(sum(INVESTIGATI), 0.0)', lo=0)} AS tot_investigati,
    count(ENTRATI) AS n_osservazioni_viag,
    {clip('avg(tasso_allarme)', 0, 1)} AS tasso_allarme_medio,
    {clip('avg(tasso_investigati)', 0, 1)} AS tasso_inv_medio,
    {outc}
  FROM travellers WHERE ROTTA IS NOT NULL GROUP BY ROTTA),
agg_t1 AS (
  SELECT g.*,
    {mode_cols},
    {safe_div('g.tot_allarmati', 'g.tot_investigati')} AS _api_raw,
    {rej} AS tasso_respinti,
    {det} AS tasso_fermati,
    {clip(f'{rej} * 0.6 + {det} * 0.4', 0, 1)} AS score_rischio_esiti
  FROM agg_t0 g
  {mode_joins}),
agg_t AS (
  SELECT * EXCLUDE (_api_raw),
    least(_api_raw, (SELECT quantile_cont(_api_raw, 0.99) FROM agg_t1)) AS alarm_per_invest
  FROM agg_t1)"""


def features_cte(alarm_src: str | None = None, traveller_src: str | None = None) -> str:
    """CTE chain ending in `features` (same columns as entity_features)."""
    from lanewatch.operators.features import ALARM_NUMERIC, TRAVELLER_CATEGORICAL, TRAVELLER_NUMERIC
    nums = ",\n    ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in ALARM_NUMERIC + TRAVELLER_NUMERIC)
    cats = ",\n    ".join(f"coalesce({c}, 'ND') AS {c}" for c in TRAVELLER_CATEGORICAL)
    blank = "('ND', '//', '')"
    feeds = []
    feeds.append(alarm_src or alarms_cte())
    feeds.append(traveller_src or travellers_cte())
    return ",\n".join(feeds + [alarm_agg_cte(), traveller_agg_cte(), f"""f0 AS (
  SELECT coalesce(a.ROTTA, t.ROTTA) AS ROTTA,
    coalesce(CASE WHEN CAST(a.ZONA AS VARCHAR) IN {blank} THEN NULL ELSE CAST(a.ZONA AS VARCHAR) END,
             CAST(t._zona_fallback AS VARCHAR), 'ND') AS ZONA,
    coalesce(CASE WHEN a.PAESE_PART IN {blank} THEN NULL ELSE a.PAESE_PART END, t._paese_fallback, 'ND') AS PAESE_PART,
    {nums},
    {cats}
  FROM agg_a a FULL OUTER JOIN agg_t t ON a.ROTTA = t.ROTTA),
features AS (
  SELECT *,
    {clip('tot_allarmi_log / greatest((SELECT max(tot_allarmi_log) FROM f0), 1.0) * 0.35 + score_rischio_esiti * 0.35 + pct_interpol * 0.15 + tasso_rilevanza * 0.15', 0, 1)} AS score_composito
  FROM f0)"""])


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def round_select(cols_types: list[tuple[str, str]], src: str, digits: int = 6) -> str:
    """SELECT with explicit casts; doubles rounded."""
    parts = []
    for c, t in cols_types:
        if t == "double":
            parts.append(f"round(CAST({c} AS DOUBLE), {digits}) AS {c}")
        elif t == "bigint":
            parts.append(f"CAST({c} AS BIGINT) AS {c}")
        elif t == "int":
            parts.append(f"CAST({c} AS INTEGER) AS {c}")
        elif t == "bool":
            parts.append(f"CAST({c} AS BOOLEAN) AS {c}")
        else:
            parts.append(f"CAST({c} AS VARCHAR) AS {c}")
    return "SELECT " + ", ".join(parts) + f" FROM {src}"


FEATS = K.BASELINE_FEATURES


def baseline_cte(src: str = "features", out: str = "baseline", prefix: str = "z_") -> str:
    """Robust z per feature + baseline_score (mean |z|)."""
    x = lambda c: f"coalesce(CAST({c} AS DOUBLE), 0.0)"
    s1 = ", ".join(f"quantile_cont({x(c)}, 0.5) AS med_{i}, stddev_samp({x(c)}) AS std_{i}"
                   for i, c in enumerate(FEATS))
    s2 = ", ".join(f"quantile_cont(abs({x(c)} - med_{i}), 0.5) AS mad_{i}" for i, c in enumerate(FEATS))
    zs = ", ".join(
        f"CASE WHEN mad_{i} > 0 THEN ({x(c)} - med_{i}) / (1.4826 * mad_{i}) "
        f"WHEN std_{i} IS NULL THEN NULL WHEN std_{i} > 0 THEN ({x(c)} - med_{i}) / std_{i} "
        f"ELSE 0.0 END AS {prefix}{c}" for i, c in enumerate(FEATS))
    num = " + ".join(f"coalesce(abs({prefix}{c}), 0.0)" for c in FEATS)
    den = " + ".join(f"(CASE WHEN {prefix}{c} IS NOT NULL THEN 1 ELSE 0 END)" for c in FEATS)
    return f"""{out}_s1 AS (SELECT {s1} FROM {src}),
{out}_s2 AS (SELECT {s2} FROM {src}, {out}_s1),
{out}_z AS (SELECT {src}.*, {zs} FROM {src}, {out}_s1, {out}_s2),
{out} AS (SELECT *, CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) END AS baseline_score FROM {out}_z)"""


def quantile_label_cte(src: str, out: str, score: str, label: str) -> str:
    return f"""{out}_q AS (SELECT quantile_cont({score}, 0.97) AS hi, quantile_cont({score}, 0.9) AS med FROM {src}),
{out} AS (SELECT {src}.*, CASE WHEN {score} >= hi THEN 'HIGH' WHEN {score} >= med THEN 'MEDIUM' ELSE 'NORMAL' END AS {label}
  FROM {src}, {out}_q)"""


def minmax_expr(col: str, src: str) -> str:
    lo = f"(SELECT min(coalesce(CAST({col} AS DOUBLE), 0.0)) FROM {src})"
    hi = f"(SELECT max(coalesce(CAST({col} AS DOUBLE), 0.0)) FROM {src})"
    return f"(CASE WHEN {hi} > {lo} THEN (coalesce(CAST({col} AS DOUBLE), 0.0) - {lo}) / ({hi} - {lo}) ELSE 0.0 END)"


def zonly_scored_cte(src: str = "baseline", out: str = "scored") -> str:
    """Ensemble with the Z detector only (weights renormalised to Z = 1)."""
    return f"""{out}_m AS (SELECT *, {minmax_expr('baseline_score', src)} AS score_z FROM {src}),
{out}_e AS (SELECT *, {clip('score_z * 1.0', 0, 1)} AS ensemble_score FROM {out}_m),
{quantile_label_cte(f'{out}_e', out, 'ensemble_score', 'anomaly_label')}"""


RULE_SQL = {
    "br_high_interpol": "pct_interpol >= 0.3",
    "br_high_rejection": "tasso_respinti >= 0.25",
    "br_low_closure": "tot_allarmi_log > 3.0 AND tasso_chiusura < 0.1",
    "br_multi_source": "pct_interpol >= 0.1 AND pct_sdi >= 0.1",
    "br_high_alarm_rate": "tasso_allarme_medio >= 0.5",
}


def tier_sql(label: str, br: str) -> str:
    return (f"CASE WHEN {label} = 'HIGH' AND {br} >= 0.4 THEN 'CRITICAL' "
            f"WHEN {label} = 'HIGH' OR ({label} = 'MEDIUM' AND {br} >= 0.4) THEN 'HIGH' "
            f"WHEN {label} = 'MEDIUM' THEN 'MEDIUM' ELSE 'LOW' END")


def risk_cte(src: str = "scored", out: str = "risk") -> str:
    flags = ", ".join(f"CAST(({e}) AS INTEGER) AS {n}" for n, e in RULE_SQL.items())
    br = "(" + " + ".join(RULE_SQL) + ") / 5.0"
    drivers = "concat_ws(' | ', " + ", ".join(
        f"CASE WHEN {n} = 1 THEN {q(K.RULE_LABELS[n])} END" for n in RULE_SQL) + ")"
    return f"""{out}_f AS (SELECT {src}.*, {flags} FROM {src}),
{out}_b AS (SELECT *, {br} AS br_score FROM {out}_f),
{out} AS (SELECT *, round_even(0.6 * coalesce(ensemble_score, 0.0) + 0.4 * br_score, 4) AS confidence,
  {tier_sql("coalesce(anomaly_label, 'NORMAL')", 'br_score')} AS final_risk,
  {drivers} AS risk_drivers
  FROM {out}_b)"""


def scaled_cte(src: str = "features", out: str = "scaled", key: str = "ROTTA") -> str:
    """Standard scaling with population std (0 -> 1), nulls as 0."""
    x = lambda c: f"coalesce(CAST({c} AS DOUBLE), 0.0)"
    st = ", ".join(f"avg({x(c)}) AS m{i}, stddev_pop({x(c)}) AS s{i}" for i, c in enumerate(FEATS))
    cols = ", ".join(f"({x(c)} - m{i}) / (CASE WHEN s{i} > 0 THEN s{i} ELSE 1.0 END) AS {c}"
                     for i, c in enumerate(FEATS))
    return f"""{out}_s AS (SELECT {st} FROM {src}),
{out} AS (SELECT {key}, {cols} FROM {src}, {out}_s)"""


def lof_cte(src: str = "scaled", out: str = "lof", key: str = "ROTTA", k: int = 20) -> str:
    dist = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS)
    return f"""{out}_pairs AS (SELECT a.{key} AS id, b.{key} AS nbr, sqrt({dist}) AS dist
  FROM {src} a JOIN {src} b ON a.{key} <> b.{key}),
{out}_knn AS (SELECT id, nbr, dist FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nbr) AS rn
  FROM {out}_pairs) WHERE rn <= least({k}, (SELECT count(*) - 1 FROM {src}))),
{out}_kd AS (SELECT id, max(dist) AS kdist FROM {out}_knn GROUP BY id),
{out}_lrd AS (SELECT k.id, 1.0 / (avg(greatest(k.dist, kd.kdist)) + 1e-10) AS lrd
  FROM {out}_knn k JOIN {out}_kd kd ON k.nbr = kd.id GROUP BY k.id),
{out}_raw AS (SELECT k.id AS {key}, avg(l.lrd) / max(p.lrd) AS lof
  FROM {out}_knn k JOIN {out}_lrd l ON k.nbr = l.id JOIN {out}_lrd p ON k.id = p.id GROUP BY k.id),
{out} AS (SELECT {key}, lof, {minmax_expr('lof', f'{out}_raw')} AS score_lof FROM {out}_raw)"""


def _md5_number(text: str, at: int) -> str:
    return f"CAST(('0x' || substr(md5({text}), {at}, 8)) AS BIGINT)"


def _draw(tree: str, what: str, seed: int) -> str:
    text = f"concat_ws('|', {tree}, CAST(node AS VARCHAR), '{seed}', '{what}')"
    return f"((({_md5_number(text, 1)}) + 0.5) / 4294967296.0)"


def iforest_cte(src: str, out: str, trees: int = 200, max_samples: int = 256, seed: int = 42, group: str | None = None,
                key: str = "ROTTA", score_src: str | None = None) -> str:
    """CTEs ending in ``out`` ([group,] key, if_score): the isolation forest grown level by level, and its scores.

    ``src`` holds the training rows, ``score_src`` the rows to score (every group scores all of them).
    """
    import math
    g = f"{group}, " if group else ""
    on_g = (lambda a, b: f"{a}.{group} = {b}.{group} AND " if group else "")
    feats = K.BASELINE_FEATURES
    levels = math.ceil(math.log2(max(max_samples, 2)))
    text = "concat_ws('|', CAST(" + key + f" AS VARCHAR), '{seed}'" + (f", CAST({group} AS VARCHAR)" if group else "") + ")"
    who = (f"CAST({group} AS VARCHAR), " if group else "") + "CAST(tree AS VARCHAR)"
    part = f"PARTITION BY {group}" if group else ""
    xs = "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in feats) + "]"
    ctes = [f"""{out}_n AS (SELECT {g}{key}, {xs} AS x, n, least({max_samples}, n) AS psi, {_md5_number(text, 1)} AS a, {_md5_number(text, 9)} AS b
  FROM (SELECT *, count(*) OVER ({part}) AS n FROM {src}))""",
            f"""{out}_0 AS (SELECT {g}tree, {key}, x, psi, CAST(ceil(log2(greatest(psi, 2))) AS INTEGER) AS top, CAST(0 AS BIGINT) AS node
  FROM (SELECT *, row_number() OVER (PARTITION BY {g}tree ORDER BY place, {key}) AS rn
        FROM (SELECT *, (a + tree * b) % 4294967291 AS place FROM {out}_n, (SELECT unnest(range({trees})) AS tree))
        WHERE place < 3.0 * 4294967291 * psi / n) WHERE rn <= psi)"""]
    for level in range(levels + 1):
        lo = ", ".join(f"min(x[{j + 1}]) OVER w" for j in range(len(feats)))
        hi = ", ".join(f"max(x[{j + 1}]) OVER w" for j in range(len(feats)))
        ctes.append(f"""{out}_w{level} AS (SELECT *, count(*) OVER w AS m, [{lo}] AS lo, [{hi}] AS hi FROM {out}_{level}
  WINDOW w AS (PARTITION BY {g}tree, node))""")
        ctes.append(f"""{out}_f{level} AS (SELECT *, CASE WHEN m > 1 AND {level} < top AND len(vary) > 0
    THEN vary[1 + CAST(floor({_draw(who, 'feature', seed)} * len(vary)) AS INTEGER)] END AS f
  FROM (SELECT *, list_filter(range(1, {len(feats) + 1}), lambda j: hi[j] > lo[j]) AS vary FROM {out}_w{level}))""")
        ctes.append(f"""{out}_s{level} AS (SELECT *, CASE WHEN cut > lo[f] THEN cut ELSE hi[f] END AS t
  FROM (SELECT *, lo[f] + {_draw(who, 'threshold', seed)} * (hi[f] - lo[f]) AS cut FROM {out}_f{level}))""")
        ctes.append(f"""{out}_{level + 1} AS (SELECT {g}tree, {key}, x, psi, top, 2 * node + CASE WHEN x[f] < t THEN 1 ELSE 2 END AS node
  FROM {out}_s{level} WHERE f IS NOT NULL)""")
    ctes.append(f"{out}_nodes AS (" + " UNION ALL ".join(
        f"""SELECT DISTINCT {g}tree, node, f, t, psi, CASE WHEN f IS NULL THEN {level} + CASE WHEN m > 2
  THEN 2.0 * (ln(m - 1.0) + 0.5772156649015329) - 2.0 * (m - 1.0) / m WHEN m = 2 THEN 1.0 ELSE 0.0 END END AS h FROM {out}_s{level}"""
        for level in range(levels + 1)) + ")")
    rows = score_src or src
    spread = f"(SELECT DISTINCT {group} FROM {src}), " if group else ""
    ctes.append(f"""{out}_p0 AS (SELECT {g}{key}, {xs} AS x, tree, CAST(0 AS BIGINT) AS node, CAST(NULL AS DOUBLE) AS h, CAST(NULL AS BIGINT) AS psi
  FROM {rows if not group else f"(SELECT {key}, {', '.join(feats)} FROM {rows})"}, {spread}(SELECT unnest(range({trees})) AS tree))""")
    for level in range(levels + 1):
        ctes.append(f"""{out}_p{level + 1} AS (SELECT {', '.join(f'p.{c}' for c in ([group] if group else []) + [key])}, p.x, p.tree,
    CASE WHEN s.f IS NULL THEN p.node WHEN p.x[s.f] < s.t THEN 2 * p.node + 1 ELSE 2 * p.node + 2 END AS node,
    coalesce(p.h, s.h) AS h, s.psi
  FROM {out}_p{level} p JOIN {out}_nodes s ON {on_g('p', 's')}p.tree = s.tree AND p.node = s.node)""")
    c = "(CASE WHEN max(psi) > 2 THEN 2.0 * (ln(max(psi) - 1.0) + 0.5772156649015329) - 2.0 * (max(psi) - 1.0) / max(psi) ELSE 1.0 END)"
    ctes.append(f"{out} AS (SELECT {g}{key}, power(2.0, -avg(h) / {c}) AS if_score FROM {out}_p{levels + 1} GROUP BY {g}{key})")
    return ",\n".join(ctes)


def shuffled_sql(i: str, n: str, label: str, walks: int = 64) -> str:
    """The keyed bijection of 0..n-1 (grid sides a and b are columns of the row)."""
    def once(x: str) -> str:
        num = lambda step, v: _md5_number(f"concat_ws('|', {label}, '{step}', CAST({v} AS VARCHAR))", 1)
        l1 = f"((({x}) // b + {num(0, f'({x}) % b')}) % a)"
        r1 = f"((({x}) % b + {num(1, l1)}) % b)"
        l2 = f"(({l1} + {num(2, r1)}) % a)"
        return f"({l2} * b + ({r1} + {num(3, l2)}) % b)"

    return (f"list_reduce(range({walks + 1}), lambda x, k: CASE WHEN k > 0 AND x < {n} THEN x ELSE {once('x')} END, CAST({i} AS BIGINT))")
