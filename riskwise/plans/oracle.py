"""Independent DuckDB SQL for the registered queries (same column names)."""

from __future__ import annotations

from riskwise import roles

LI = roles.LINEITEM


def _li_filled() -> str:
    """lineitem features with zeros as NULL, filled with the exact lower median."""
    return """
    li_base AS (
      SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
             nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
             l_discount AS raw_discount, l_tax AS raw_tax,
             CAST(l_returnflag = 'R' AS INTEGER) AS label
      FROM lineitem),
    li_med AS (
      SELECT quantile_disc(l_discount, 0.5) AS m_disc, quantile_disc(l_tax, 0.5) AS m_tax FROM li_base),
    li_filled AS (
      SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
             coalesce(l_discount, m_disc) AS l_discount, coalesce(l_tax, m_tax) AS l_tax, label, raw_discount, raw_tax
      FROM li_base, li_med),
    li_stats AS (
      SELECT avg(l_quantity) AS a1, stddev_samp(l_quantity) AS s1,
             avg(l_extendedprice) AS a2, stddev_samp(l_extendedprice) AS s2,
             avg(l_discount) AS a3, stddev_samp(l_discount) AS s3,
             avg(l_tax) AS a4, stddev_samp(l_tax) AS s4
      FROM li_filled),
    li_z AS (
      SELECT l_orderkey, l_linenumber, label, l_quantity, l_extendedprice, l_discount, l_tax, raw_discount, raw_tax,
             (l_quantity - a1) / s1 AS z1, (l_extendedprice - a2) / s2 AS z2,
             (l_discount - a3) / s3 AS z3, (l_tax - a4) / s4 AS z4
      FROM li_filled, li_stats),
    li_scored AS (
      SELECT *, 1.0 / (1.0 + exp(-({b} + {w1} * z1 + {w2} * z2 + {w3} * z3 + {w4} * z4))) AS p
      FROM li_z)
    """.format(b=LI.intercept, w1=LI.weights[0], w2=LI.weights[1], w3=LI.weights[2], w4=LI.weights[3])


def _band(p: str) -> str:
    e1, e2 = roles.BAND_EDGES
    n0, n1, n2 = roles.BAND_NAMES
    return (f"CASE WHEN {p} IS NULL THEN NULL WHEN {p} * 100.0 < {e1} THEN '{n0}' "
            f"WHEN {p} * 100.0 < {e2} THEN '{n1}' ELSE '{n2}' END")


FEATS = list(LI.features)
ZM = set(LI.zero_missing)


def _feat(c: str) -> str:
    return f"nullif({c}, 0)" if c in ZM else c


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


_missing = _union(
    f"SELECT '{c}' AS column, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST(count_if({c} = 0) AS BIGINT) AS n_zero, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM lineitem"
    for c in FEATS)

_describe = "WITH li AS (SELECT " + ", ".join(f"{_feat(c)} AS {c}" for c in FEATS) + " FROM lineitem)\n" + _union(
    f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM li"
    for c in FEATS)

_hist = "WITH li AS (SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem)\n" + _union(
    f"SELECT '{c}' AS column, CAST(floor({c} / {float(w)}) AS BIGINT) AS bin, label, count(*) AS n "
    f"FROM li WHERE {c} IS NOT NULL GROUP BY 2, 3"
    for c, w in LI.hist_width.items())


def _corr_sql() -> str:
    cols = FEATS + ["label"]
    parts = []
    for i, a in enumerate(cols):
        for j in range(len(cols)):
            b = cols[j]
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            r = (f"round(covar_samp({a}, {b}) / nullif(stddev_samp(CASE WHEN {both} THEN {a} END) * "
                 f"stddev_samp(CASE WHEN {both} THEN {b} END), 0), 6)")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r} AS r FROM li")
    return ("WITH li AS (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, l_extendedprice, l_discount, l_tax, "
            "CAST(l_returnflag = 'R' AS DOUBLE) AS label FROM lineitem)\n" + _union(parts))


_H = "CAST(concat('0x', substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)"
_LI_ALL_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_H2 = ("CAST(concat('0x', substr(md5(concat_ws('|', "
       + ", ".join(f"CAST({c} AS VARCHAR)" for c in _LI_ALL_COLS) + ")), 1, 13)) AS BIGINT)")


def _std_sql(fn: str) -> str:
    stats = ", ".join(f"avg({c}) AS a_{c}, {fn}({c}) AS s_{c}" for c in FEATS)
    z = ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) AS z_{c}" for c in FEATS)
    return (f"WITH {_li_filled()}, st AS (SELECT {stats} FROM li_filled)\n"
            f"SELECT l_orderkey, l_linenumber, {z} FROM li_filled, st")


def _guidance_sql(rules, default) -> str:
    cases = ", ".join(f"CASE WHEN {c} > {float(t)} THEN '{txt}' END" for c, t, txt in rules)
    g = f"concat_ws(chr(10), {cases})"
    return f"CASE WHEN coalesce({g}, '') = '' THEN '{default}' ELSE {g} END"


def _diag(pred: str) -> str:
    w0, w1 = roles.DIAGNOSIS_WORDS
    return f"CASE WHEN {pred} = 1 THEN '{w1}' WHEN {pred} = 0 THEN '{w0}' END"


def _long_sql() -> str:
    """(model, label, p, prediction) for every fixed scorer."""
    parts = []
    for name, w, b in roles.LINEITEM_SCORERS:
        m = " + ".join(f"{float(wi)} * z{i + 1}" for i, wi in enumerate(w))
        parts.append(f"SELECT '{name}' AS model, label, 1.0 / (1.0 + exp(-({float(b)} + {m}))) AS p FROM li_z")
    return (f"WITH {_li_filled()}, lg AS (" + _union(parts) + "),\n"
            f"sc AS (SELECT model, label, p, CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER) AS prediction FROM lg)")


def _rnd(x: str, digits) -> str:
    return x if digits is None else f"round({x}, {digits})"


def _cls_sql(src: str, group: str = "", digits=6) -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
    c AS (SELECT {g}
            CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp,
            CAST(count_if(label = 0 AND prediction = 1) AS DOUBLE) AS fp,
            CAST(count_if(label = 1 AND prediction = 0) AS DOUBLE) AS fn,
            CAST(count_if(label = 0 AND prediction = 0) AS DOUBLE) AS tn
          FROM {src} {gb}),
    r AS (SELECT *, tp + fp + fn + tn AS n,
            coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
            coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0
          FROM c),
    m AS (SELECT {g} {_rnd("coalesce((tp + tn) / nullif(n, 0), 0)", digits)} AS accuracy,
            {_rnd("p1 * coalesce((tp + fn) / nullif(n, 0), 0) + p0 * coalesce((tn + fp) / nullif(n, 0), 0)", digits)} AS precision,
            {_rnd("r1 * coalesce((tp + fn) / nullif(n, 0), 0) + r0 * coalesce((tn + fp) / nullif(n, 0), 0)", digits)} AS recall,
            {_rnd("coalesce(2.0 * p1 * r1 / nullif(p1 + r1, 0), 0) * coalesce((tp + fn) / nullif(n, 0), 0) + coalesce(2.0 * p0 * r0 / nullif(p0 + r0, 0), 0) * coalesce((tn + fp) / nullif(n, 0), 0)", digits)} AS f1_score,
            {_rnd("p1", digits)} AS precision_pos, {_rnd("r1", digits)} AS recall_pos,
            {_rnd("coalesce(2.0 * p1 * r1 / nullif(p1 + r1, 0), 0)", digits)} AS f1_pos
          FROM r)"""


def _auc_sql(src: str, group: str = "", digits=6) -> str:
    pg = f"PARTITION BY {group}" if group else ""
    pgp = f"PARTITION BY {group}, p" if group else "PARTITION BY p"
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
    rk AS (SELECT {g} label, (2 * rank() OVER ({pg} ORDER BY p) + count(*) OVER ({pgp}) - 1) / 2.0 AS mr FROM {src}),
    auc AS (SELECT {g} {_rnd("(sum(CASE WHEN label = 1 THEN mr END) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0) / (CAST(count_if(label = 1) AS DOUBLE) * count_if(label = 0))", digits)} AS roc_auc
            FROM rk {gb})"""


_ROC = f"""
    b AS (SELECT CAST(floor(p * 10000) AS BIGINT) AS bucket, sum(label) AS pos, sum(1 - label) AS neg
          FROM li_scored GROUP BY 1),
    cum AS (SELECT bucket, sum(pos) OVER (ORDER BY bucket DESC ROWS UNBOUNDED PRECEDING) AS tp,
                   sum(neg) OVER (ORDER BY bucket DESC ROWS UNBOUNDED PRECEDING) AS fp,
                   sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM b),
    roc AS (SELECT round(bucket / 10000.0, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
                   round(tp / P, 6) AS tpr, round(fp / N, 6) AS fpr FROM cum)"""

_METRICS = ("accuracy", "roc_auc", "f1_score", "precision", "recall")


def _wide_sql(digits=6) -> str:
    return (_long_sql() + ", " + _cls_sql("sc", "model", digits) + ", " + _auc_sql("sc", "model", digits)
            + ",\n wide AS (SELECT m.model, accuracy, roc_auc, f1_score, precision, recall "
              "FROM m JOIN auc USING (model))")


_ORDER = " ".join(f"WHEN '{n}' THEN {i}" for i, (n, _, _) in enumerate(roles.LINEITEM_SCORERS))

def _feed_sql() -> str:
    (lv, hv), (lk, hk) = roles.FEED_CLIP["value"], roles.FEED_CLIP["k"]
    w1, w2 = roles.FEED_WEIGHTS
    d0, d1 = roles.FEED_DIAGNOSIS
    return f"""
    ev AS (SELECT event_id, ts, event_type AS feed_key, least(greatest(value, {lv}), {hv}) AS value,
                  least(greatest(CAST(json_extract_string(props, '$.k') AS DOUBLE), {lk}), {hk}) AS k
           FROM events),
    fst AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(k) AS mk, stddev_samp(k) AS sk FROM ev),
    fp AS (SELECT ev.*, 1.0 / (1.0 + exp(-({roles.FEED_INTERCEPT} + {w1} * ((value - mv) / sv)
                                            + {w2} * ((k - mk) / sk)))) AS p FROM ev, fst),
    fsc AS (SELECT *, CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER) AS prediction,
                   round(p * 100.0, 1) AS risk_pct,
                   printf('PT-%04d', event_id) AS tag, strftime(ts, '%H:%M:%S') AS clock
            FROM fp),
    feed AS (SELECT *, CASE WHEN prediction = 1 THEN '{d1}' WHEN prediction = 0 THEN '{d0}' END AS diagnosis FROM fsc)"""


_LAST20 = f"""
    WITH {_feed_sql()}
    SELECT event_id, feed_key,
           count(*) OVER w AS n_window, CAST(sum(prediction) OVER w AS BIGINT) AS n_pos,
           round(CAST(sum(prediction) OVER w AS DOUBLE) / count(*) OVER w, 6) AS pos_rate
    FROM feed
    WINDOW w AS (PARTITION BY feed_key ORDER BY ts, event_id ROWS BETWEEN {roles.FEED_HISTORY - 1} PRECEDING AND CURRENT ROW)"""

_FEED_SCORE = f"WITH {_feed_sql()} SELECT event_id, feed_key, tag, clock, value, k, risk_pct, diagnosis FROM feed"

_NEWEST = f"""
    nw AS (SELECT *, CAST(row_number() OVER (PARTITION BY feed_key ORDER BY ts DESC, event_id DESC) AS INTEGER) AS position
           FROM feed QUALIFY position <= {roles.FEED_HISTORY})"""

_LI_ALL_LIST = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_ALL = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
           "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

ORACLE = {
    "risk_bands": f"""
    WITH {_li_filled()}
    SELECT {_band('p')} AS band, count(*) AS n, round(avg(p), 6) AS avg_p
    FROM li_scored GROUP BY 1
    """,
    "missing_profile": _missing,
    "kpis": """
    SELECT count(*) AS n_total, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_positive,
           CAST(count_if(l_returnflag <> 'R') AS BIGINT) AS n_negative,
           round(avg(l_quantity), 6) AS mean_l_quantity, round(avg(nullif(l_discount, 0)), 6) AS mean_l_discount,
           round(count_if(l_returnflag = 'R') * 100.0 / count(*), 6) AS prevalence_pct
    FROM lineitem""",
    "label_counts": """
    SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, count(*) AS n FROM lineitem GROUP BY 1""",
    "group_means": "SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, " + ", ".join(
        f"round(avg({_feat(c)}), 6) AS mean_{c}" for c in FEATS) + " FROM lineitem GROUP BY 1",
    "describe": _describe,
    "histogram_by_label": _hist,
    "corr_matrix": _corr_sql(),
    "median_surrogates": """
    SELECT 'l_discount' AS column, quantile_disc(nullif(l_discount, 0), 0.5) AS surrogate FROM lineitem
    UNION ALL
    SELECT 'l_tax', quantile_disc(nullif(l_tax, 0), 0.5) FROM lineitem""",
    "impute_median": f"WITH {_li_filled()} SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM li_filled",
    "standardize_samp": _std_sql("stddev_samp"),
    "standardize_pop": _std_sql("stddev_pop"),
    "hash_split": f"""
    SELECT CASE WHEN {_H} % 100 < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n,
           CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_pos
    FROM lineitem GROUP BY 1""",
    "fold_assign": f"""
    SELECT CAST({_H} % 3 AS INTEGER) AS fold, count(*) AS n, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_pos
    FROM lineitem GROUP BY 1""",
    "stratified_split": f"""
    WITH t AS (
      SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
             row_number() OVER (PARTITION BY l_returnflag = 'R' ORDER BY {_H}, {_H2}) AS rn,
             count(*) OVER (PARTITION BY l_returnflag = 'R') AS n_label
      FROM lineitem)
    SELECT label, CASE WHEN rn <= ceil(0.2 * n_label) THEN 'test' ELSE 'train' END AS split, count(*) AS n
    FROM t GROUP BY 1, 2""",
    "linear_score": f"""
    WITH {_li_filled()}
    SELECT l_orderkey, l_linenumber, label, round(p, 6) AS p,
           CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER) AS prediction, round(p * 100.0, 1) AS risk_pct
    FROM li_scored""",
    "score_labels": f"""
    WITH {_li_filled()}
    SELECT l_orderkey, l_linenumber, {_diag(f'CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER)')} AS diagnosis,
           {_band('p')} AS band, printf('%.2f%%', p * 100.0) AS confidence,
           round(p * 100.0, 1) >= {roles.ALERT_PCT} AS alert
    FROM li_scored""",
    "margin_to_probability": f"WITH {_li_filled()} SELECT l_orderkey, l_linenumber, round(p, 6) AS p_margin FROM li_scored",
    "contributions": f"WITH {_li_filled()}\n" + _union(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS feature, round({float(w)} * z{i + 1}, 6) AS contribution FROM li_z"
        for i, (c, w) in enumerate(zip(FEATS, LI.weights))),
    "guidance_rules": "SELECT l_orderkey, l_linenumber, " + _guidance_sql(
        roles.LINEITEM_GUIDANCE, roles.LINEITEM_GUIDANCE_DEFAULT) + " AS guidance FROM lineitem",
    "report_text": f"""
    WITH {_li_filled()}
    SELECT l_orderkey, l_linenumber, concat_ws(chr(10), 'MEASUREMENTS:',
      {', '.join(f"coalesce(printf('- {c}: %.2f', {c}), '- {c}: not measured')" for c in FEATS)},
      'OUTCOME:', '- Predictive Diagnostic: ' || {_diag(f'CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER)')},
      '- Confidence Score: ' || printf('%.2f%%', p * 100.0),
      {', '.join(f"CASE WHEN coalesce({c}, 0) = 0 THEN '- Imputed for scoring: {c}' END" for c in LI.zero_missing)},
      'GUIDANCE:', {_guidance_sql(roles.LINEITEM_GUIDANCE, roles.LINEITEM_GUIDANCE_DEFAULT)}) AS report
    FROM (SELECT l_orderkey, l_linenumber, p, l_quantity, l_extendedprice, raw_discount AS l_discount,
                 raw_tax AS l_tax FROM li_scored)""",
    "confusion": f"""
    WITH {_li_filled()}
    SELECT label, CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER) AS prediction, count(*) AS n
    FROM li_scored GROUP BY 1, 2""",
    "classification_metrics": f"""
    WITH {_li_filled()}, sc AS (SELECT label, CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER) AS prediction
                                FROM li_scored), {_cls_sql('sc')}
    SELECT accuracy, precision, recall, f1_score, precision_pos, recall_pos, f1_pos FROM m""",
    "roc_curve": f"WITH {_li_filled()}, {_ROC} SELECT * FROM roc",
    "roc_points": f"""
    WITH {_li_filled()}, s AS (SELECT p, sum(label) AS pos, sum(1 - label) AS neg FROM li_scored GROUP BY 1),
    c AS (SELECT p, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
                 sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg
          FROM s WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING))
    SELECT round(p, 6) AS threshold, tp, fp, round(tp / n_pos, 6) AS tpr, round(fp / n_neg, 6) AS fpr FROM c""",
    "roc_auc_trapezoid": f"""
    WITH {_li_filled()}, {_ROC},
    seg AS (SELECT fp, tp, lag(fp, 1, 0) OVER (ORDER BY fp, tp) AS pf,
                   lag(tp, 1, 0) OVER (ORDER BY fp, tp) AS pt FROM roc)
    SELECT round(sum((fp - pf) * (tp + pt) / 2.0) / (CAST(max(fp) AS DOUBLE) * max(tp)), 6) AS auc_trapezoid FROM seg""",
    "auc_exact": f"WITH {_li_filled()}, {_auc_sql('li_scored')} SELECT roc_auc FROM auc",
    "metrics_unpivot": _wide_sql() + """
    SELECT model, metric, score FROM wide
    UNPIVOT (score FOR metric IN (accuracy, roc_auc, f1_score, precision, recall))""",
    "metrics_pivot": _wide_sql() + " SELECT * FROM wide",
    "leaderboard": _wide_sql() + f"""
    SELECT model, roc_auc, CAST(row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, CASE model {_ORDER} END) AS INTEGER) AS rank,
           row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, CASE model {_ORDER} END) = 1 AS champion
    FROM wide""",
    "metric_labels": _wide_sql(None) + """
    SELECT model, replace(upper(metric), '_', '-') AS metric_label, printf('%.4f', score) AS score_text FROM wide
    UNPIVOT (score FOR metric IN (accuracy, roc_auc, f1_score, precision, recall))""",
    "coef_rank": f"""
    WITH {_li_filled()}, w AS (
      {_union(f"SELECT '{c}' AS feature, round(regr_slope(CAST(label AS DOUBLE), z{i + 1}), 6) AS weight FROM li_z"
              for i, c in enumerate(FEATS))})
    SELECT feature, weight, CAST(row_number() OVER (ORDER BY abs(weight), feature) AS INTEGER) AS abs_rank FROM w""",
    "feed_score": _FEED_SCORE,
    "stream_score": _FEED_SCORE,
    "last20_rate": _LAST20,
    "stream_last20": _LAST20,
    "newest20": f"WITH {_feed_sql()}, {_NEWEST} SELECT feed_key, event_id, position, risk_pct, diagnosis FROM nw",
    "timeline": f"""
    WITH {_feed_sql()}, top AS (SELECT * FROM feed ORDER BY ts DESC, event_id DESC LIMIT {roles.FEED_HISTORY})
    SELECT CAST(row_number() OVER (ORDER BY ts, event_id) AS INTEGER) AS step, event_id, feed_key, clock, risk_pct
    FROM top""",
    "feed_kpis": f"""
    WITH {_feed_sql()}, {_NEWEST}
    SELECT feed_key, count(*) AS n_retained,
           round(CAST(sum(prediction) AS DOUBLE) * 100.0 / count(*), 6) AS positive_pct,
           max(CASE WHEN position = 1 THEN risk_pct END) AS latest_risk_pct
    FROM nw GROUP BY 1""",
    "stream_trend": f"""
    WITH {_feed_sql()}
    SELECT date_trunc('day', ts) AS window_start, feed_key, count(*) AS n, round(avg(risk_pct), 6) AS avg_risk_pct
    FROM feed GROUP BY 1, 2""",
    "doc_features": """
    SELECT d.doc_id, l.quality, d.n_chars,
           CAST(len(regexp_extract_all(d.text, '\\S+')) AS BIGINT) AS n_words,
           CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
           CAST(length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits,
           CAST(length(regexp_replace(d.text, '[^.,;:!?]', '', 'g')) AS BIGINT) AS n_punct,
           CAST(length(regexp_replace(d.text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
    FROM documents d JOIN labels l USING (doc_id)""",
    "embedding_group_means": """
    WITH e AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
    SELECT label, CAST(dim AS INTEGER) AS dim, round(avg(CAST(v AS DOUBLE)), 6) AS mean FROM e GROUP BY 1, 2""",
    "embedding_corr": """
    WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v,
                      generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
    SELECT CAST(a.dim AS INTEGER) AS dim_a, CAST(b.dim AS INTEGER) AS dim_b, round(corr(a.v, b.v), 6) AS r
    FROM e a JOIN e b USING (vec_id) GROUP BY 1, 2""",
    "embedding_standardize": """
    WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v,
                      generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
    s AS (SELECT dim, avg(v) AS m, stddev_samp(v) AS sd FROM e GROUP BY 1)
    SELECT vec_id, CAST(dim AS INTEGER) AS dim, round((v - m) / sd, 6) AS z FROM e JOIN s USING (dim)""",
    "csv_scan": """
    SELECT count(*) AS n_total, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_positive,
           CAST(count_if(l_returnflag <> 'R') AS BIGINT) AS n_negative,
           round(avg(l_quantity), 6) AS mean_l_quantity, round(avg(nullif(l_discount, 0)), 6) AS mean_l_discount,
           round(count_if(l_returnflag = 'R') * 100.0 / count(*), 6) AS prevalence_pct
    FROM lineitem""",
    "schema_ingest": """
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity, l_extendedprice, l_discount, l_tax
    FROM lineitem""",
    "first_rows": f"SELECT {_LI_ALL} FROM lineitem ORDER BY {_LI_ALL} LIMIT 5",
    "clip_bounds": "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"least(greatest({c}, {float(lo)}), {float(hi)}) AS {c}" for c, (lo, hi) in LI.clip.items()) + " FROM lineitem",
}

# sinks read back what the source queries produced
ORACLE["metrics_json"] = ORACLE["metrics_unpivot"]
ORACLE["predictions_sink"] = ORACLE["linear_score"]

_w = roles.LINEITEM_SCORERS[0]
ORACLE["metrics_document"] = _wide_sql() + ", tall AS (SELECT model, metric, score FROM wide UNPIVOT (score FOR metric IN (" \
    + ", ".join(_METRICS) + f""")))
    SELECT 'metric' AS section, model AS name, metric AS item, score AS value FROM tall
    UNION ALL SELECT 'coefficient', '{_w[0]}', item, value FROM (VALUES {
    ", ".join(f"('{c}', CAST({float(x)} AS DOUBLE))" for c, x in [*zip(FEATS, _w[1]), ("(intercept)", _w[2])])}) t(item, value)
    UNION ALL SELECT 'meta', model, 'best_roc_auc', roc_auc FROM (
      SELECT model, roc_auc FROM wide ORDER BY roc_auc DESC, CASE model {_ORDER} END LIMIT 1)"""

_DH = _H.replace("l_orderkey", "doc_id")
_DOC_TRAIN = (f"d AS (SELECT quality, {_DH} % 100 < 80 AS train, CAST({_DH} % 3 AS INTEGER) AS fold "
              "FROM documents JOIN labels USING (doc_id))")
ORACLE["learner_checks"] = f"""
    WITH {_DOC_TRAIN},
    g(model, grid_points) AS (VALUES ('LogisticRegression', 9), ('DecisionTree', 3), ('RandomForest', 9),
                                     ('GradientBoosting', 6), ('SupportVectorMachine', 4))
    SELECT model, any_value(grid_points) AS grid_points, count_if(train) AS n_train, count_if(NOT train) AS n_test,
           count_if(NOT train AND quality = 1) AS n_test_pos, true AS surrogates_ok, true AS scaler_ok,
           true AS prediction_follows_score, true AS reload_agrees, true AS metrics_agree
    FROM g JOIN d ON true GROUP BY 1"""
ORACLE["tuning_checks"] = f"""
    WITH {_DOC_TRAIN}
    SELECT fold, count(*) AS n, count_if(quality = 1) AS n_pos, 2 AS grid_points, true AS winner_ok, true AS gradient_ok
    FROM d WHERE train GROUP BY 1"""
ORACLE["ml_form_checks"] = "SELECT unnest([" + ", ".join(
    f"'median rank of {c}'" for c in LI.zero_missing) + ", 'binned ROC-AUC']) AS \"check\", true AS ok"
ORACLE["stream_model_score"] = ORACLE["doc_features"].replace("l.quality, ", "").replace(
    "FROM documents d JOIN labels l USING (doc_id)", ", true AS agrees FROM documents d")

# records with faults by key: what scoring needs decides, one reason per field, in field order
_W = LI.weights
ORACLE["quarantine_batch"] = f"""
    WITH {_li_filled()},
    f AS (SELECT l_orderkey, l_linenumber, (l_orderkey * 7 + l_linenumber) % 40 AS f, z1, z2, z3,
                 CASE WHEN (l_orderkey * 7 + l_linenumber) % 40 IN (4, 6) THEN (m_tax - a4) / s4 ELSE z4 END AS z4
          FROM li_z, li_stats, li_med),
    r AS (SELECT *, concat_ws('; ', CASE WHEN f = 7 THEN 'malformed line' END,
                              CASE f WHEN 0 THEN 'l_quantity: missing' WHEN 3 THEN 'l_quantity: not double' END,
                              CASE f WHEN 1 THEN 'l_extendedprice: NaN' WHEN 3 THEN 'l_extendedprice: missing'
                                     WHEN 5 THEN 'l_extendedprice: not finite' END,
                              CASE WHEN f = 2 THEN 'l_discount: not double' END) AS reasons,
                 1.0 / (1.0 + exp(-({LI.intercept} + {_W[0]} * z1 + {_W[1]} * z2 + {_W[2]} * z3 + {_W[3]} * z4))) AS p FROM f)
    SELECT l_orderkey, l_linenumber, reasons = '' AS accepted, reasons, CASE WHEN reasons = '' THEN round(p, 6) END AS p,
           CASE WHEN reasons = '' THEN CAST(p > {roles.DECISION_THRESHOLD} AS INTEGER) END AS prediction
    FROM r"""
ORACLE["quarantine_stream"] = f"""
    WITH {_feed_sql()},
    r AS (SELECT *, concat_ws('; ', CASE WHEN ts IS NULL OR event_id % 30 = 3 THEN 'ts: missing' END,
                              CASE event_id % 30 WHEN 0 THEN 'value: missing' WHEN 1 THEN 'value: NaN'
                                                 WHEN 4 THEN 'value: not finite' END,
                              CASE WHEN event_id % 30 IN (2, 4) OR k IS NULL THEN 'k: missing' END) AS reasons FROM feed)
    SELECT event_id, feed_key, reasons = '' AS accepted, reasons, CASE WHEN reasons = '' THEN risk_pct END AS risk_pct,
           CASE WHEN reasons = '' THEN diagnosis END AS diagnosis, CASE WHEN reasons = '' THEN clock END AS clock
    FROM r"""

# a point stays unless its step and the next lower threshold's step are the same
ORACLE["roc_reduced"] = f"""
    WITH {_li_filled()}, s AS (SELECT p, sum(label) AS pos, sum(1 - label) AS neg FROM li_scored GROUP BY 1),
    c AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
                 sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg, lag(p) OVER w AS higher,
                 lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
          FROM s WINDOW w AS (ORDER BY p DESC))
    SELECT round(p, 6) AS threshold, tp, fp, round(tp / n_pos, 6) AS tpr, round(fp / n_neg, 6) AS fpr FROM c
    WHERE higher IS NULL OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg"""
ORACLE["model_publication"] = ORACLE["standardize_samp"]
_RULE_CASES = ", ".join(f"CASE WHEN {c} > {float(t)} THEN '{txt}' END" for c, t, txt in roles.LINEITEM_GUIDANCE)
ORACLE["guidance_table"] = f"""
    WITH g AS (SELECT l_orderkey, l_linenumber, concat_ws(chr(10), {_RULE_CASES},
        CASE WHEN l_quantity > 10 AND l_quantity <= 20 THEN printf('- Quantity is moderate (%.1f).', CAST(l_quantity AS DOUBLE)) END,
        CASE WHEN l_quantity > 15 AND l_quantity <= 45 THEN '- Quantity is above 15 and up to 45.' END,
        CASE WHEN l_tax <= 0 THEN '- No tax.' END) AS g FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN coalesce(g, '') = '' THEN '{roles.LINEITEM_GUIDANCE_DEFAULT}' ELSE g END AS guidance
    FROM g"""
ORACLE["tree_contributions"] = f"SELECT doc_id, CAST({len(roles.DOC_FEATURES)} AS BIGINT) AS n_terms, true AS agrees FROM documents"
