"""DuckDB SQL for the checked queries.

Written as named pieces (``VIEWS``) that a query pulls in by name, so that one
definition of the feedback table or of the score serves all of them.
"""

from __future__ import annotations

import re

from earshot.catalogue import PRIORITY_WEIGHTS, SENTIMENT_SEVERITY
from earshot.checks import tables as t


def _values(rows) -> str:
    def cell(v):
        if v is None:
            return "CAST(NULL AS VARCHAR)"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return str(v)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def _table(columns: str, rows) -> str:
    return f"SELECT * FROM (VALUES {_values(rows)}) AS v({columns})"


def _six(*names: str) -> str:
    return ", ".join(f"round({n} * 1000000.0) / 1000000.0 AS {n}" for n in names)


def _rolling(source: str, at: str) -> str:
    return f"""
    SELECT *, (recent_avg - baseline_mean) / nullif(baseline_std, 0) AS z_score,
           (recent_avg - baseline_mean) / nullif(baseline_mean, 0) AS change
    FROM (
      SELECT theme, {at}, theme_share, theme_count,
        CASE WHEN count(*) OVER far >= 14 THEN avg(theme_share) OVER far END AS baseline_mean,
        CASE WHEN count(*) OVER far >= 14 THEN stddev_samp(theme_share) OVER far END AS baseline_std,
        CASE WHEN count(*) OVER near = 7 THEN avg(theme_share) OVER near END AS recent_avg
      FROM {source}
      WINDOW far AS (PARTITION BY theme ORDER BY {at} ROWS BETWEEN 36 PRECEDING AND 7 PRECEDING),
             near AS (PARTITION BY theme ORDER BY {at} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


_FLAGS = """
    CASE WHEN round(z_score * 1000000.0) / 1000000.0 > 3 AND round(change * 1000000.0) / 1000000.0 > 1 THEN 1 ELSE 0 END AS is_alert,
    CASE WHEN round(z_score * 1000000.0) / 1000000.0 > 1 AND round(change * 1000000.0) / 1000000.0 > 0.25 THEN 1 ELSE 0 END AS is_relaxed_alert"""

_METRICS = _six("theme_share", "baseline_mean", "baseline_std", "recent_avg", "z_score", "change")

_SCORE = " + ".join(f"{name} * CAST({w} AS DOUBLE)" for name, w in PRIORITY_WEIGHTS.items())

_ASCII = "regexp_extract_all(lower(text), '[a-z0-9]{2,}')"

VIEWS = {
    "theme_list": _table(
        "ord, theme, label, severity, aspect",
        [(i, th.code, th.label, th.severity, th.aspect) for i, th in enumerate(t.THEMES, start=1)],
    ),
    "tier_list": _table("segment, tier, churn", [(s, r, t.CHURN_OF[r]) for s, r in t.TIER_OF.items()]),
    "sentiment_list": _table(
        "status, sentiment, weight", [(k, s, SENTIMENT_SEVERITY[s]) for k, s in t.SENTIMENT_OF.items()]
    ),
    "fb_theme": """
    SELECT DISTINCT l_orderkey AS feedback_id, ord, theme
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN theme_list ON theme = p_type""",
    "fb_lists": """
    SELECT feedback_id, string_agg(theme, '|' ORDER BY ord) AS theme_text, count(*) AS n_themes,
           arg_min(theme, ord) AS first_theme, arg_max(theme, ord) AS last_theme
    FROM fb_theme GROUP BY feedback_id""",
    "fb": """
    SELECT o_orderkey AS feedback_id, o_custkey AS customer_id, o_orderpriority AS channel,
           CAST(o_orderdate AS DATE) AS feedback_date, s.sentiment AS predicted_sentiment, s.weight,
           CAST(500 + (o_orderkey * 37) % 501 AS DOUBLE) / 1000.0 AS sentiment_confidence, o_totalprice
    FROM orders LEFT JOIN sentiment_list s ON s.status = o_orderstatus""",
    "fbx": """
    SELECT fb.*, l.product_id, coalesce(theme_text, 'unclassified') AS theme_text,
           coalesce(n_themes, 1) AS n_themes, coalesce(first_theme, 'unclassified') AS primary_theme,
           coalesce(last_theme, 'unclassified') AS last_theme, tl.label AS theme_label_primary, tl.severity
    FROM fb LEFT JOIN fb_lists USING (feedback_id)
      LEFT JOIN (SELECT l_orderkey AS feedback_id, min(l_partkey) AS product_id FROM lineitem GROUP BY 1) l USING (feedback_id)
      LEFT JOIN theme_list tl ON tl.theme = first_theme""",
    "cust": """
    SELECT c_custkey AS customer_id, r_name AS region, tier, c_acctbal AS lifetime_value, churn AS base_churn_prob
    FROM customer LEFT JOIN tier_list ON segment = c_mktsegment
      LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
    "prod": """
    SELECT p_partkey AS product_id, p_brand AS category, p_retailprice AS price,
           CASE WHEN p_size <= 40 THEN 'normal' WHEN p_size <= 47 THEN 'elevated' ELSE 'high' END AS quality_risk
    FROM part""",
    "theme_day": """
    SELECT feedback_date, theme, count(*) AS theme_count
    FROM (SELECT feedback_date, unnest(string_split(theme_text, '|')) AS theme FROM fbx) GROUP BY 1, 2""",
    "daily": """
    SELECT theme_day.feedback_date, theme, theme_count, total_feedback,
           CAST(theme_count AS DOUBLE) / total_feedback AS theme_share, label AS theme_label
    FROM theme_day JOIN (SELECT feedback_date, count(*) AS total_feedback FROM fb GROUP BY 1) USING (feedback_date)
      LEFT JOIN theme_list USING (theme)""",
    "calendar": """
    SELECT g.theme, g.feedback_date, coalesce(theme_share, 0.0) AS theme_share, coalesce(theme_count, 0) AS theme_count
    FROM (SELECT theme, CAST(unnest(generate_series(CAST(min(feedback_date) AS TIMESTAMP), CAST(max(feedback_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS feedback_date
          FROM daily GROUP BY theme) g
      LEFT JOIN daily USING (theme, feedback_date)""",
    "metrics": _rolling("calendar", "feedback_date"),
    "latest": "SELECT * FROM metrics QUALIFY row_number() OVER (PARTITION BY theme ORDER BY feedback_date DESC) = 1",
    "hourly": """
    SELECT date_trunc('hour', ts) AS hour, event_type AS theme, count(*) AS theme_count,
           CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY date_trunc('hour', ts)) AS theme_share
    FROM events GROUP BY 1, 2""",
    "hour_grid": """
    SELECT g.theme, g.hour, coalesce(theme_share, 0.0) AS theme_share, coalesce(theme_count, 0) AS theme_count
    FROM (SELECT theme, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM hourly GROUP BY theme) g
      LEFT JOIN hourly USING (theme, hour)""",
    "hour_metrics": _rolling("hour_grid", "hour"),
    "part_phrases": """
    SELECT list_aggregate(w, 'string_agg', ' ') AS phrase, min(ord) AS ord, arg_max(theme, ord) AS theme, arg_max(sentiment, ord) AS sentiment
    FROM (SELECT p_partkey * 4 + kind AS ord, p_type AS theme, sentiment, regexp_extract_all(lower(phrase), '[a-z0-9]+') AS w
          FROM (SELECT p_partkey, p_type, 0 AS kind, 'negative' AS sentiment, p_name || ' ' || p_size AS phrase FROM part
                UNION ALL SELECT p_partkey, p_type, 1, 'positive', p_type || ' ' || p_name || ' ' || p_size FROM part
                UNION ALL SELECT p_partkey, p_type, 2, 'neutral', p_brand || ' ' || p_type || ' ' || p_name FROM part
                UNION ALL SELECT p_partkey, p_type, 3, 'negative', p_brand || ' ' || p_type || ' ' || p_name || ' ' || p_size FROM part))
    GROUP BY w""",
    "order_texts": """
    SELECT l_orderkey AS doc_id, string_agg(
        CASE WHEN l_linenumber % 2 = 0 THEN p_type || ' ' || p_name || ' - ' || p_size
             ELSE p_brand || ' ' || p_type || ' ' || p_name || ' ' || p_size END, '; ' ORDER BY l_linenumber, l_partkey) AS text
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""",
    "word_hits": """
    SELECT doc_id, p.ord, phrase, p.theme, sentiment, tl.aspect
    FROM (SELECT DISTINCT doc_id, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS gram
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM order_texts),
                     (SELECT DISTINCT len(string_split(phrase, ' ')) AS n FROM part_phrases)))
      JOIN part_phrases p ON p.phrase = gram LEFT JOIN theme_list tl ON tl.theme = p.theme""",
    "ranked": """
    SELECT fbx.*, tier, region, lifetime_value, base_churn_prob,
      CASE WHEN lifetime_value IS NOT NULL THEN
        (rank() OVER (ORDER BY lifetime_value NULLS LAST) - 1
         + CAST(count(*) OVER (PARTITION BY lifetime_value) + 1 AS DOUBLE) / 2.0)
        / CAST(count(lifetime_value) OVER () AS DOUBLE) END AS customer_value_score,
      CAST(coalesce(sum(CASE WHEN predicted_sentiment = 'negative' THEN 1 ELSE 0 END) OVER (
        PARTITION BY customer_id ORDER BY feedback_date, feedback_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS repeat_negative_count
    FROM fbx LEFT JOIN cust USING (customer_id)""",
    "parts_of_score": """
    SELECT ranked.*, weight * sentiment_confidence AS sentiment_severity_score,
      coalesce(severity, 0.4) AS theme_severity,
      CASE WHEN base_churn_prob * (1.0 + f * 0.5) > 1.0 THEN 1.0 ELSE base_churn_prob * (1.0 + f * 0.5) END AS churn_risk_score,
      CASE WHEN theme_label_primary IN (SELECT coalesce(label, theme) FROM growing) THEN 1.0 ELSE 0.0 END AS issue_growth_score,
      tanh(CAST(repeat_negative_count AS DOUBLE) / 3.0) AS repeat_complaint_score
    FROM (SELECT *, CASE WHEN predicted_sentiment = 'negative' THEN 1 ELSE 0 END AS f FROM ranked) ranked""",
    "points": f"SELECT *, round_even(({_SCORE}) * 100.0 * 10.0, 0) / 10.0 AS priority_score FROM parts_of_score",
    "scored": """
    SELECT *, CASE WHEN priority_score >= 65 THEN 'Critical' WHEN priority_score >= 45 THEN 'High'
                   WHEN priority_score >= 25 THEN 'Medium' ELSE 'Low' END AS priority_tier
    FROM points""",
    "lex": _table(
        "ord, phrase, theme, sentiment, aspect",
        [(i, p.text, p.theme, p.sentiment, t.DOC_ASPECTS.get(p.theme)) for i, p in enumerate(t.DOC_LEXICON, start=1)],
    ),
    "hits": """
    SELECT doc_id, ord, phrase, theme, sentiment, aspect
    FROM (SELECT doc_id, lower(text) AS low FROM documents) JOIN lex ON contains(low, phrase)""",
    "doc_themes": """
    SELECT doc_id, string_agg(theme, '|' ORDER BY o) AS found
    FROM (SELECT doc_id, theme, min(ord) AS o FROM hits GROUP BY 1, 2) GROUP BY 1""",
    "doc_aspects": """
    SELECT doc_id, aspect, min(ord) AS o, arg_max(sentiment, ord) AS sentiment
    FROM hits WHERE aspect IS NOT NULL GROUP BY 1, 2""",
    "valence_words": _table("token, points", list(t.DOC_VALENCES.items())),
    "doc_valence": f"""
    SELECT doc_id, total, CAST(total AS DOUBLE) / sqrt(CAST(total * total AS DOUBLE) + 15.0) AS compound
    FROM (SELECT doc_id, CAST(coalesce(sum(points), 0) AS BIGINT) AS total
          FROM documents LEFT JOIN (SELECT doc_id, unnest({_ASCII}) AS token FROM documents) w USING (doc_id)
            LEFT JOIN valence_words USING (token) GROUP BY 1)""",
    "doc_label": """
    SELECT doc_id, total, compound,
      CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS label
    FROM doc_valence""",
    "doc_truth": """
    SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS truth
    FROM documents JOIN labels USING (doc_id)""",
    "keyword_list": _table(
        "ord, aspect, place, keyword",
        [(i, a, j, w) for i, (a, ws) in enumerate(t.DOC_KEYWORDS.items(), start=1) for j, w in enumerate(ws, start=1)],
    ),
    "judged": "SELECT truth, label AS predicted FROM doc_truth JOIN doc_label USING (doc_id)",
    "three": _table("label", [("negative",), ("neutral",), ("positive",)]),
    "matrix": """
    SELECT a.label AS truth, b.label AS predicted, count(j.truth) AS n
    FROM three a CROSS JOIN three b LEFT JOIN judged j ON j.truth = a.label AND j.predicted = b.label GROUP BY 1, 2""",
    "per_label": """
    SELECT label, hits, support,
      coalesce(hits / nullif(CAST(claimed AS DOUBLE), 0), 0) AS precision,
      coalesce(hits / nullif(CAST(support AS DOUBLE), 0), 0) AS recall,
      coalesce(2 * hits / nullif(CAST(claimed + support AS DOUBLE), 0), 0) AS f1
    FROM (SELECT label, CAST(sum(CASE WHEN truth = label AND predicted = label THEN n ELSE 0 END) AS BIGINT) AS hits,
                 CAST(sum(CASE WHEN truth = label THEN n ELSE 0 END) AS BIGINT) AS support,
                 CAST(sum(CASE WHEN predicted = label THEN n ELSE 0 END) AS BIGINT) AS claimed
          FROM matrix, three GROUP BY label)""",
}

_STOP = ("the", "and", "of", "to", "in", "is", "that", "it", "was", "for", "on", "with", "this", "as", "be", "are", "by")
# RE2 has no look-around: mark the breaks first, then cut at the marks. The
# second pass finds a conjunction whose blank the first one had consumed.
_TURN = r"\s+((?:[Bb]ut|[Hh]owever)(?:[^\p{L}\p{N}_]|$))"
VIEWS["clause_rows"] = f"""
    SELECT doc_id, text, list_filter(string_split(
        regexp_replace(regexp_replace(regexp_replace(text, '([.!])\\s+', '\\1' || chr(1), 'g'),
          '{_TURN}', chr(1) || '\\1', 'g'), '{_TURN}', chr(1) || '\\1', 'g'), chr(1)),
        lambda piece: regexp_matches(piece, '\\S')) AS pieces
    FROM documents"""
VIEWS["keyword_rows"] = """
    SELECT doc_id, k.ord, k.aspect, arg_min(keyword, place) AS keyword
    FROM (SELECT doc_id, lower(text) AS low FROM documents) JOIN keyword_list k ON contains(low, keyword) GROUP BY 1, 2, 3"""
VIEWS["keyword_clause"] = """
    SELECT doc_id, ord, aspect, coalesce(list_filter(pieces, lambda piece: contains(lower(piece), keyword))[1], text) AS text
    FROM keyword_rows JOIN clause_rows USING (doc_id)"""
VIEWS["terms"] = f"""
    SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_ASCII}) AS term FROM documents)
    WHERE term NOT IN {_STOP} GROUP BY 1, 2"""
VIEWS["vocab"] = """
    SELECT term, df, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx
    FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM terms GROUP BY 1 HAVING count(*) >= 5
          ORDER BY cf DESC, term LIMIT 5000)"""
VIEWS["weighted"] = """
    SELECT doc_id, term, idx, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
    FROM (SELECT *, tf * (ln((1 + (SELECT count(*) FROM documents)) / CAST(1 + df AS DOUBLE)) + 1.0) AS w FROM terms JOIN vocab USING (term))"""
VIEWS["grams"] = f"""
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
          FROM (SELECT doc_id, {_ASCII} AS w FROM documents)) GROUP BY 1, 2"""
VIEWS["gram_vocab"] = """
    SELECT term, df FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM grams GROUP BY 1 HAVING count(*) >= 3
                          ORDER BY cf DESC, term LIMIT 20000)"""
VIEWS["gram_weights"] = """
    SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
    FROM (SELECT *, tf * (ln((1 + (SELECT count(*) FROM documents)) / CAST(1 + df AS DOUBLE)) + 1.0) AS w FROM grams JOIN gram_vocab USING (term))"""
VIEWS["argmax"] = "SELECT vec_id, label, list_position(embedding, list_max(embedding)) - 1 AS topic FROM embeddings"
VIEWS["majority"] = """
    SELECT topic, sum(c) AS n, arg_min(label, (-c, label)) AS best, max(c) AS hits
    FROM (SELECT topic, label, count(*) AS c FROM argmax GROUP BY 1, 2) GROUP BY 1"""

# issue growth counts only where a query asks for the relaxed alerts
_GROWING = {
    False: "SELECT theme, label FROM theme_list WHERE false",
    True: """
    SELECT theme, label FROM latest LEFT JOIN theme_list USING (theme)
    WHERE coalesce(z_score > 1 AND change > 0.25, false)""",
}


def _needs(sql: str, views: dict[str, str]) -> list[str]:
    """Names of the views a text uses, inner ones first."""
    out: list[str] = []
    for name in views:
        if re.search(rf"\b{name}\b", sql):
            for inner in [*_needs(views[name], {k: v for k, v in views.items() if k != name}), name]:
                if inner not in out:
                    out.append(inner)
    return out


def sql(body: str, with_alerts: bool = False) -> str:
    views = {**VIEWS, "growing": _GROWING[with_alerts]}
    names = _needs(body, views)
    head = ",\n".join(f"{n} AS ({views[n].strip()})" for n in names)
    return (f"WITH {head}\n" if head else "") + body.strip()


_MEAN_SCORE = "CAST(sum(CAST(round(priority_score * 10) AS BIGINT)) AS DOUBLE) / 10.0 / count(priority_score)"
#: Compared to nine decimals: the sums of doubles differ in the last bits with the order of rows.
_MEAN_CHURN = "round(avg(churn_risk_score) * 1000000000.0) / 1000000000.0"
_NEG = "predicted_sentiment = 'negative'"
_NEG_RATE = f"CAST(count(*) FILTER (WHERE {_NEG}) AS DOUBLE) / count(*)"

ORACLES: dict[str, str] = {
    # reports
    "sentiment_trend_month": sql("""
    SELECT strftime(feedback_date, '%Y-%m') AS month, predicted_sentiment, count(*) AS feedback_count,
           round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY strftime(feedback_date, '%Y-%m')), 2) AS pct_of_month
    FROM fb GROUP BY 1, 2"""),
    "worsening_products": sql(f"""
    SELECT category, n_recent, neg_rate_recent, neg_rate_prior, round(neg_rate_recent - neg_rate_prior, 3) AS pct_point_change
    FROM (SELECT category, count(*) AS n_recent, {_NEG_RATE} AS neg_rate_recent FROM fbx JOIN prod USING (product_id)
          WHERE feedback_date >= (SELECT max(feedback_date) FROM fb) - 90 GROUP BY 1)
    JOIN (SELECT category, count(*) AS n_prior, {_NEG_RATE} AS neg_rate_prior FROM fbx JOIN prod USING (product_id)
          WHERE feedback_date < (SELECT max(feedback_date) FROM fb) - 90
            AND feedback_date >= (SELECT max(feedback_date) FROM fb) - 180 GROUP BY 1) USING (category)
    WHERE n_recent >= 10 AND n_prior >= 10
    ORDER BY pct_point_change DESC, category LIMIT 25"""),
    "complaint_mix": sql(f"""
    SELECT theme_label_primary AS issue_category, channel, count(*) AS complaint_count,
           round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct_of_all_complaints
    FROM fbx WHERE {_NEG} GROUP BY 1, 2"""),
    "repeat_complainers": sql(f"""
    SELECT customer_id, tier, lifetime_value, count(*) AS negative_feedback_count,
           min(feedback_date) AS first_complaint, max(feedback_date) AS latest_complaint
    FROM fb JOIN cust USING (customer_id) WHERE {_NEG}
    GROUP BY 1, 2, 3 HAVING count(*) >= 3
    ORDER BY negative_feedback_count DESC, lifetime_value DESC, customer_id LIMIT 100"""),
    "customer_360": sql("""
    SELECT feedback_id, feedback_date, channel, theme_label_primary, predicted_sentiment, priority_tier, priority_score
    FROM scored WHERE customer_id = 7"""),
    "channel_performance": sql(f"""
    SELECT channel, count(*) AS total_feedback, round({_NEG_RATE}, 3) AS negative_rate,
           round({_MEAN_SCORE}, 1) AS avg_priority_score,
           count(*) FILTER (WHERE priority_tier = 'Critical') AS critical_count
    FROM scored GROUP BY 1"""),
    "sentiment_churn": sql(f"""
    SELECT predicted_sentiment, round({_MEAN_CHURN}, 3) AS avg_churn_risk_score, count(*) AS n
    FROM scored GROUP BY 1"""),
    "repeat_gap_days": sql(f"""
    SELECT theme_label_primary, count(*) AS repeat_events,
           round(avg(date_diff('day', prev, feedback_date)), 1) AS avg_days_between_repeat_complaints
    FROM (SELECT *, lag(feedback_date) OVER (PARTITION BY customer_id, theme_label_primary ORDER BY feedback_date) AS prev
          FROM fbx WHERE {_NEG})
    WHERE prev IS NOT NULL GROUP BY 1"""),
    "theme_share_45d": sql("""
    SELECT feedback_date, theme, theme_label, theme_share, theme_count, total_feedback
    FROM daily WHERE feedback_date >= (SELECT max(feedback_date) FROM daily) - 45"""),
    # projections, lookups, strings
    "theme_labels": sql("""
    SELECT feedback_id, primary_theme, theme_label_primary,
           coalesce(theme_label_primary, primary_theme) AS label_or_code, coalesce(severity, 0.4) AS theme_severity
    FROM fbx"""),
    "theme_strings": sql("""
    SELECT feedback_id, theme_text,
           replace(theme_text, '|', ':' || predicted_sentiment || '|') || ':' || predicted_sentiment AS pair_text,
           primary_theme AS first_theme, CAST(n_themes AS INTEGER) AS n_themes, last_theme, predicted_sentiment AS last_sentiment
    FROM fbx"""),
    "order_value": sql("""
    SELECT l_orderkey, l_linenumber, l_partkey, round_even(price * l_quantity * 100.0, 0) / 100.0 AS order_value
    FROM lineitem LEFT JOIN prod ON product_id = l_partkey"""),
    "majority_sentiment": sql("""
    SELECT feedback_id, negatives, neutrals, positives,
      CASE WHEN negatives >= greatest(positives, neutrals)
             THEN CASE WHEN negatives > 0 THEN 'negative' WHEN neutrals > 0 THEN 'neutral' ELSE 'positive' END
           WHEN positives > neutrals THEN 'positive' ELSE 'neutral' END AS overall_sentiment
    FROM (SELECT feedback_id, count(*) FILTER (WHERE flag = 'R') AS negatives,
                 count(*) FILTER (WHERE flag = 'N') AS neutrals, count(*) FILTER (WHERE flag = 'A') AS positives
          FROM (SELECT l_orderkey AS feedback_id, p_type,
                       arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_returnflag)) AS flag
                FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
          GROUP BY 1)"""),
    "margin_confidence": sql("""
    SELECT feedback_id, round_even((0.5::DOUBLE + 0.5::DOUBLE * ((o_totalprice - low) / (high - low))) * 1000.0, 0) / 1000.0 AS sentiment_confidence
    FROM fb, (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM fb)"""),
    "stratified_split": sql("""
    SELECT feedback_id, predicted_sentiment,
      CASE WHEN row_number() OVER (PARTITION BY predicted_sentiment ORDER BY (feedback_id * 48271 + 42) % 2147483647, feedback_id)
             <= floor(count(*) OVER (PARTITION BY predicted_sentiment) * 0.2 + 0.5) THEN 1 ELSE 0 END AS is_test
    FROM fb"""),
    # history, ranks, priority
    "prior_complaints": sql("SELECT feedback_id, customer_id, repeat_negative_count FROM ranked"),
    "prior_complaints_split": sql("SELECT feedback_id, customer_id, repeat_negative_count FROM ranked"),
    "value_percentile": sql("""
    SELECT feedback_id, round(customer_value_score * 1000000000.0) / 1000000000.0 AS customer_value_score FROM ranked"""),
    "priority_components": sql(
        f"SELECT feedback_id, {_six(*PRIORITY_WEIGHTS)} FROM parts_of_score", with_alerts=True),
    "priority_score": sql(
        "SELECT feedback_id, repeat_negative_count, priority_score, priority_tier FROM scored", with_alerts=True),
    "priority_tiers": sql("""
    SELECT priority_tier, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
    FROM scored GROUP BY 1"""),
    "priority_sanity": sql("""
    SELECT predicted_sentiment, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
    FROM scored WHERE priority_tier IN ('Critical', 'High') GROUP BY 1"""),
    "top_priority": sql("""
    SELECT feedback_id, customer_id, priority_score, priority_tier FROM scored
    ORDER BY priority_score DESC, feedback_id LIMIT 25"""),
    "explain_cards": sql("""
    SELECT feedback_id,
      upper(predicted_sentiment[1]) || predicted_sentiment[2:] || ' — ' || CAST(CAST(round_even(sentiment_confidence * 100.0, 0) AS INTEGER) AS VARCHAR) || '%' AS sentiment,
      theme_label_primary AS primary_issue,
      coalesce((SELECT string_agg(label, '|' ORDER BY ord) FROM fb_theme f JOIN theme_list USING (theme, ord)
                WHERE f.feedback_id = scored.feedback_id AND theme <> primary_theme), '') AS secondary_issues,
      priority_tier AS severity, tier AS customer_value, CAST(repeat_negative_count AS INTEGER) AS repeat_complaints_before_this,
      CAST(issue_growth_score AS INTEGER) AS part_of_emerging_issue, priority_tier AS recommended_priority, priority_score
    FROM scored ORDER BY priority_score DESC, feedback_id LIMIT 25""", with_alerts=True),
    # trends
    "theme_daily_share": sql("SELECT feedback_date, theme, theme_count, total_feedback, theme_share, theme_label FROM daily"),
    "theme_calendar": sql("SELECT theme, feedback_date, theme_share, theme_count FROM calendar"),
    "emerging_daily": sql(f"SELECT theme, feedback_date, theme_count, {_METRICS}, {_FLAGS} FROM metrics"),
    "emerging_hourly": sql(f"SELECT theme, strftime(hour, '%Y-%m-%d %H') AS hour, theme_count, {_METRICS}, {_FLAGS} FROM hour_metrics"),
    "emerging_latest": sql(f"SELECT theme, feedback_date, {_METRICS}, {_FLAGS} FROM latest"),
    "alert_messages": sql("""
    SELECT theme, baseline_share_pct, recent_7d_share_pct, pct_change, z AS z_score,
      CASE WHEN z_score > 0.5 THEN 'Critical' ELSE 'High' END AS severity,
      '\U0001F6A8 Emerging Issue Detected: ' || theme || printf(' complaints rose from a baseline of %.2f%% to %.2f%% of feedback over the last 7 days (+%.0f%%, z=%.1f).',
        baseline_share_pct, recent_7d_share_pct, round_even(change * 100.0, 0), round_even(z_score * 10.0, 0) / 10.0) AS message
    FROM (SELECT coalesce(label, l.theme) AS theme, z_score, change,
            round_even(baseline_mean * 100.0 * 100.0, 0) / 100.0 AS baseline_share_pct,
            round_even(recent_avg * 100.0 * 100.0, 0) / 100.0 AS recent_7d_share_pct,
            round_even(change * 100.0 * 10.0, 0) / 10.0 AS pct_change, round_even(z_score * 100.0, 0) / 100.0 AS z
          FROM latest l LEFT JOIN theme_list tl ON tl.theme = l.theme WHERE z_score > -1 AND change > -0.5)"""),
    "theme_rate_split": sql("""
    SELECT 'PROMO' AS theme, n_after, hits_after, n_before, hits_before,
           CAST(hits_after AS DOUBLE) / n_after AS rate_after, CAST(hits_before AS DOUBLE) / n_before AS rate_before
    FROM (SELECT count(*) FILTER (WHERE late) AS n_after, count(*) FILTER (WHERE late AND has) AS hits_after,
                 count(*) FILTER (WHERE NOT late) AS n_before, count(*) FILTER (WHERE NOT late AND has) AS hits_before
          FROM (SELECT contains(theme_text, 'PROMO') AS has,
                       feedback_date > (SELECT max(feedback_date) FROM fb) - 90 AS late FROM fbx))"""),
    # marts
    "mart_fact_feedback": sql("""
    SELECT feedback_id, customer_id, product_id, channel, feedback_date, predicted_sentiment, sentiment_confidence,
           theme_label_primary, priority_score, priority_tier, churn_risk_score, tier, lifetime_value FROM scored"""),
    "mart_executive": sql(f"""
    SELECT count(*) AS total_feedback,
      round_even(CAST(count(*) FILTER (WHERE {_NEG}) AS DOUBLE) / count(*) * 100.0 * 10.0, 0) / 10.0 AS negative_sentiment_pct,
      round_even(CAST(count(*) FILTER (WHERE predicted_sentiment = 'positive') AS DOUBLE) / count(*) * 100.0 * 10.0, 0) / 10.0 AS csat_proxy_pct,
      (SELECT count(*) FROM latest WHERE coalesce(z_score > 1 AND change > 0.25, false)) AS emerging_issues_count,
      count(*) FILTER (WHERE priority_tier = 'Critical') AS critical_complaints_count,
      round_even((100.0::DOUBLE - CAST(count(*) FILTER (WHERE priority_tier IN ('Critical', 'High')) AS DOUBLE) / count(*) * 100.0) * 10.0, 0) / 10.0 AS resolution_rate_proxy_pct,
      count(DISTINCT customer_id) FILTER (WHERE churn_risk_score > 0.2) AS at_risk_customers_count,
      (SELECT theme_label_primary FROM scored WHERE {_NEG} AND theme_label_primary IS NOT NULL
       GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_complaint_topic,
      count(*) FILTER (WHERE feedback_date > (SELECT max(feedback_date) FROM fb) - 30) AS last_30d_feedback_volume,
      max(feedback_date) AS as_of_date
    FROM scored"""),
    "mart_sentiment_trend": sql("""
    SELECT strftime(feedback_date, '%Y-%m') AS month, predicted_sentiment AS sentiment, count(*) AS count FROM fb GROUP BY 1, 2"""),
    "mart_topic": sql(f"""
    SELECT theme_label_primary, count(*) AS volume, {_NEG_RATE} AS negative_rate, {_MEAN_SCORE} AS avg_priority_score
    FROM scored WHERE theme_label_primary IS NOT NULL GROUP BY 1"""),
    "mart_product": sql(f"""
    SELECT product_id, category, quality_risk, count(*) AS feedback_volume, {_NEG_RATE} AS negative_rate, {_MEAN_SCORE} AS avg_priority_score
    FROM scored JOIN prod USING (product_id) GROUP BY 1, 2, 3"""),
    "mart_channel": sql(f"""
    SELECT channel, count(*) AS volume, {_NEG_RATE} AS negative_rate, {_MEAN_SCORE} AS avg_priority_score,
           count(*) FILTER (WHERE priority_tier = 'Critical') AS critical_count
    FROM scored GROUP BY 1"""),
    "mart_customer_risk": sql(f"""
    SELECT customer_id, tier, lifetime_value, count(*) AS feedback_count,
           count(*) FILTER (WHERE {_NEG}) AS negative_count, {_MEAN_CHURN} AS avg_churn_risk_score,
           max(priority_score) AS max_priority_score
    FROM scored WHERE tier IS NOT NULL AND lifetime_value IS NOT NULL GROUP BY 1, 2, 3"""),
    "action_queue": sql("""
    SELECT feedback_id, customer_id, tier, channel, feedback_date, theme_label_primary, predicted_sentiment, priority_score, priority_tier
    FROM scored WHERE priority_tier IN ('Critical', 'High')"""),
    # quality
    "dq_row_counts": sql("""
    SELECT *, (expected = actual)::INT AS ok FROM (
      SELECT 'feedback' AS table_name, (SELECT count(*) FROM orders) AS expected, (SELECT count(*) FROM fbx) AS actual
      UNION ALL SELECT 'customers', (SELECT count(*) FROM customer), (SELECT count(*) FROM cust)
      UNION ALL SELECT 'products', (SELECT count(*) FROM part), (SELECT count(*) FROM prod)
      UNION ALL SELECT 'feedback with a theme', (SELECT count(*) FROM orders), (SELECT count(DISTINCT l_orderkey) FROM lineitem))"""),
    "dq_tier_reconcile": sql("""
    SELECT *, (critical + high + medium + low = fact_rows)::INT AS adds_up
    FROM (SELECT fact, count(*) FILTER (WHERE seen AND priority_tier = 'Critical') AS critical, count(*) FILTER (WHERE seen AND priority_tier = 'High') AS high,
                 count(*) FILTER (WHERE seen AND priority_tier = 'Medium') AS medium, count(*) FILTER (WHERE seen AND priority_tier = 'Low') AS low,
                 count(*) AS fact_rows
          FROM (SELECT fact, priority_tier, fact = 'whole' OR channel <> '1-URGENT' AS seen
                FROM scored, (VALUES ('whole'), ('broken')) AS v(fact)) GROUP BY fact)"""),
    "dq_orphans": sql("""
    SELECT 'customer_id' AS key_name, count(*) FILTER (WHERE customer_id IS NULL) AS null_rows,
           count(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM cust)) AS orphan_rows,
           count(DISTINCT customer_id) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM cust)) AS orphan_keys FROM fbx
    UNION ALL
    SELECT 'product_id', count(*) FILTER (WHERE product_id IS NULL),
           count(*) FILTER (WHERE product_id NOT IN (SELECT product_id FROM prod)),
           count(DISTINCT product_id) FILTER (WHERE product_id NOT IN (SELECT product_id FROM prod)) FROM fbx"""),
    # text
    "lexicon_table": sql("""
    SELECT first[1] AS theme_pos, first[2] AS sentiment_pos, first[3] AS phrase_pos, phrase, theme, sentiment
    FROM (SELECT phrase, min([pos, sp, pp]) AS first, arg_max(theme, [pos, sp, pp]) AS theme, arg_max(sentiment, [pos, sp, pp]) AS sentiment
          FROM (SELECT p_partkey AS pos, 0::BIGINT AS sp, 0::BIGINT AS pp, p_type AS theme, 'negative' AS sentiment, lower(p_name) AS phrase FROM part
                UNION ALL SELECT p_partkey, 0, 1, p_type, 'negative', lower(p_brand || ' ' || p_name) FROM part
                UNION ALL SELECT p_partkey, 1, 0, p_type, 'positive', lower(p_name || ' ' || p_size) FROM part)
          GROUP BY 1)"""),
    "lexicon_hits": sql("SELECT doc_id, ord, phrase, theme, sentiment, aspect FROM hits"),
    "infer_themes": sql("""
    SELECT doc_id, coalesce(found, 'unclassified') AS inferred_themes FROM documents LEFT JOIN doc_themes USING (doc_id)"""),
    "lexicon_aspects": sql("""
    SELECT doc_id, coalesce(pairs, 'None Detected') AS detected_aspects, CAST(coalesce(n, 0) AS INTEGER) AS n_aspects_detected, coalesce(found, 'unclassified') AS inferred_themes
    FROM documents LEFT JOIN doc_themes USING (doc_id)
      LEFT JOIN (SELECT doc_id, string_agg(aspect || ':' || upper(sentiment[1]) || sentiment[2:], '|' ORDER BY o) AS pairs, count(*) AS n FROM doc_aspects GROUP BY 1) USING (doc_id)"""),
    "valence_sentiment": sql(f"SELECT doc_id, total, {_six('compound')}, label FROM doc_label"),
    "keyword_aspects": sql("""
    SELECT doc_id, ord, aspect, keyword, label
    FROM keyword_rows JOIN doc_label USING (doc_id)"""),
    "clause_split": sql("""
    SELECT doc_id, CAST(generate_subscripts(pieces, 1) - 1 AS INTEGER) AS pos, unnest(pieces) AS clause FROM clause_rows"""),
    "keyword_aspect_clauses": sql(f"""
    SELECT doc_id, ord, aspect, {_six('compound')},
      CASE WHEN compound >= 0.05 THEN 'positive' WHEN compound <= -0.05 THEN 'negative' ELSE 'neutral' END AS label
    FROM (SELECT doc_id, ord, aspect, CAST(total AS DOUBLE) / sqrt(CAST(total * total AS DOUBLE) + 15.0) AS compound
          FROM (SELECT doc_id, ord, aspect, CAST(coalesce(sum(points), 0) AS BIGINT) AS total
                FROM (SELECT doc_id, ord, aspect, unnest(CASE WHEN len({_ASCII}) = 0 THEN [''] ELSE {_ASCII} END) AS token FROM keyword_clause)
                  LEFT JOIN valence_words USING (token) GROUP BY 1, 2, 3))"""),
    "aspect_agreement": sql("""
    SELECT correct, total, CAST(correct AS DOUBLE) / total AS agreement
    FROM (SELECT count(*) AS total, count(*) FILTER (WHERE d.sentiment = p.sentiment) AS correct
          FROM (SELECT doc_id, 'Tone' AS aspect, 'negative' AS sentiment FROM doc_truth WHERE truth = 'negative'
                UNION ALL SELECT doc_id, 'Praise', 'positive' FROM doc_truth WHERE truth <> 'negative'
                UNION ALL SELECT doc_id, 'Terms', 'neutral' FROM doc_truth WHERE truth = 'neutral') p
            LEFT JOIN doc_aspects d ON d.doc_id = p.doc_id AND d.aspect = p.aspect)"""),
    "confusion_matrix": sql("SELECT truth, predicted, n FROM matrix"),
    "classification_report": sql(f"""
    SELECT label, {_six('precision', 'recall', 'f1')}, support FROM (
      SELECT label, precision, recall, f1, support FROM per_label
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_label
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_label
      UNION ALL SELECT 'accuracy', CAST(sum(hits) AS DOUBLE) / sum(support), CAST(sum(hits) AS DOUBLE) / sum(support),
                       CAST(sum(hits) AS DOUBLE) / sum(support), CAST(sum(support) AS BIGINT) FROM per_label)"""),
}
ORACLES.update(
    {
        "term_counts": sql("SELECT doc_id, term, idx, tf FROM terms JOIN vocab USING (term)"),
        "tfidf_weights": sql(f"SELECT doc_id, term, idx, tf, {_six('weight')} FROM weighted"),
        "tfidf_features": sql(f"""
    SELECT term, n_docs, {_six('weight_sum')} FROM (SELECT term, count(*) AS n_docs, sum(weight) AS weight_sum FROM gram_weights GROUP BY 1)"""),
        "topic_argmax": sql("SELECT vec_id, label, topic FROM argmax"),
        "topic_majority": sql("SELECT topic AS cluster, CAST(n AS BIGINT) AS n, best AS majority, hits FROM majority"),
        "topic_purity": sql("""
    SELECT CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(n) AS BIGINT) AS n, CAST(sum(hits) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS purity FROM majority"""),
        "stream_theme_counts": sql("""
    SELECT CAST(ts AS DATE) AS feedback_date, event_type AS theme, count(*) AS theme_count FROM events GROUP BY 1, 2"""),
    }
)
ORACLES.update(
    {
        "lexicon_hits_words": sql("SELECT doc_id, ord, phrase, theme, sentiment, aspect FROM word_hits"),
        "lexicon_words_tags": sql("""
    SELECT doc_id, coalesce(pairs, 'None Detected') AS detected_aspects, CAST(coalesce(n, 0) AS INTEGER) AS n_aspects_detected,
           coalesce(found, 'unclassified') AS inferred_themes
    FROM order_texts
      LEFT JOIN (SELECT doc_id, string_agg(theme, '|' ORDER BY o) AS found
                 FROM (SELECT doc_id, theme, min(ord) AS o FROM word_hits GROUP BY ALL) GROUP BY 1) USING (doc_id)
      LEFT JOIN (SELECT doc_id, string_agg(aspect || ':' || upper(sentiment[1]) || sentiment[2:], '|' ORDER BY o) AS pairs, count(*) AS n
                 FROM (SELECT doc_id, aspect, min(ord) AS o, arg_max(sentiment, ord) AS sentiment
                       FROM word_hits WHERE aspect IS NOT NULL GROUP BY ALL) GROUP BY 1) USING (doc_id)"""),
        "stream_emerging": ORACLES["emerging_daily"],
        "explain_cards_stored": ORACLES["explain_cards"],
        "dominant_truth": sql("""
    SELECT doc_id, CASE truth WHEN 'negative' THEN 'insult' WHEN 'positive' THEN 'praise' ELSE 'rights' END AS dominant_true_theme FROM doc_truth"""),
        "lexicon_file": """
    SELECT CAST(row_number() OVER (ORDER BY phrase) AS INTEGER) AS ord, phrase, theme,
           CASE WHEN theme = 'PROMO' THEN 'positive' ELSE 'negative' END AS sentiment
    FROM (SELECT DISTINCT lower(p_brand || ' ' || p_type) AS phrase, p_type AS theme FROM part)""",
        "cluster_top_terms": sql(f"""
    SELECT topic, CAST(rank AS INTEGER) AS rank, term, {_six('weight')} FROM (
      SELECT topic, term, weight, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank
      FROM (SELECT CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 END AS topic, term, sum(weight) AS weight
            FROM weighted JOIN (SELECT doc_id, lang FROM documents) USING (doc_id) GROUP BY 1, 2))
    WHERE rank <= 5 AND topic IS NOT NULL"""),
        "kmeans_given_start": """
    WITH cells AS MATERIALIZED (
      SELECT vec_id, unnest(generate_series(1, len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
    c0 AS (SELECT topic, i, x FROM cells JOIN (
      SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS topic FROM embeddings ORDER BY vec_id LIMIT 10) USING (vec_id)),
    n0 AS MATERIALIZED (SELECT vec_id, arg_min(topic, (d, topic)) AS topic FROM (
      SELECT vec_id, topic, sum((a.x - c.x) * (a.x - c.x)) AS d FROM cells a JOIN c0 c USING (i) GROUP BY ALL) GROUP BY 1),
    c1 AS (SELECT c.topic, c.i, coalesce(m.x, c.x) AS x FROM c0 c LEFT JOIN (
      SELECT topic, i, avg(x) AS x FROM cells JOIN n0 USING (vec_id) GROUP BY ALL) m ON m.topic = c.topic AND m.i = c.i),
    n1 AS MATERIALIZED (SELECT vec_id, arg_min(topic, (d, topic)) AS topic FROM (
      SELECT vec_id, topic, sum((a.x - c.x) * (a.x - c.x)) AS d FROM cells a JOIN c1 c USING (i) GROUP BY ALL) GROUP BY 1),
    c2 AS (SELECT c.topic, c.i, coalesce(m.x, c.x) AS x FROM c1 c LEFT JOIN (
      SELECT topic, i, avg(x) AS x FROM cells JOIN n1 USING (vec_id) GROUP BY ALL) m ON m.topic = c.topic AND m.i = c.i)
    SELECT vec_id, CAST(arg_min(topic, (d, topic)) AS INTEGER) AS topic FROM (
      SELECT vec_id, topic, sum((a.x - c.x) * (a.x - c.x)) AS d FROM cells a JOIN c2 c USING (i) GROUP BY ALL) GROUP BY 1""",
        "worsening_products_stored": ORACLES["worsening_products"],
        "theme_share_45d_stored": ORACLES["theme_share_45d"],
        "mart_executive_stored": ORACLES["mart_executive"],
        "customer_360_stored": ORACLES["customer_360"],
        "dq_checks": sql("""
    SELECT check_name, expected, actual, (expected = actual)::INT AS ok FROM (
      SELECT 'rows' AS check_name, (SELECT count(*) FROM orders) AS expected, (SELECT count(*) FROM scored) AS actual
      UNION ALL SELECT 'tiers', (SELECT count(*) FROM scored), (SELECT count(*) FROM scored WHERE priority_tier IN ('Critical', 'High', 'Medium', 'Low'))
      UNION ALL SELECT 'orphans customer_id', 0, (SELECT count(*) FROM fbx WHERE customer_id NOT IN (SELECT customer_id FROM cust))
      UNION ALL SELECT 'orphans product_id', 0, (SELECT count(*) FROM fbx WHERE product_id NOT IN (SELECT product_id FROM prod))
      UNION ALL SELECT 'amiss: rows', (SELECT count(*) + 1 FROM orders), (SELECT count(*) FROM scored)
      UNION ALL SELECT 'amiss: tiers', (SELECT count(*) FROM scored), (SELECT count(*) FROM scored WHERE priority_tier IN ('Critical', 'High'))
      UNION ALL SELECT 'amiss: orphans customer_id', 0, (SELECT count(*) FROM fbx WHERE customer_id NOT IN (SELECT customer_id FROM cust WHERE tier <> 'Gold'))
      UNION ALL SELECT 'amiss: orphans product_id', 0, (SELECT count(*) FROM fbx WHERE product_id NOT IN (SELECT product_id FROM prod WHERE quality_risk = 'normal')))"""),
        "project_metrics": sql("""
    SELECT 'feedback_interactions' AS metric, count(*) AS n FROM orders UNION ALL SELECT 'customers', count(*) FROM customer
    UNION ALL SELECT 'products', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM lineitem
    UNION ALL SELECT 'priority_distribution.' || v.name, (SELECT count(*) FROM scored WHERE priority_tier = v.name)
    FROM (VALUES ('Critical'), ('High'), ('Medium'), ('Low')) AS v(name)"""),
        "csv_quarantine": """
    SELECT reason, count(*) AS n, CAST(sum(k) AS BIGINT) AS ids, count(*) FILTER (reason = 'kept' AND k % 17 <> 7 AND has_value) AS n_values
    FROM (SELECT o_orderkey AS k, o_totalprice IS NOT NULL AS has_value,
            CASE WHEN o_orderkey % 19 = 2 OR o_orderkey % 23 = 4 THEN 'fields' WHEN o_orderkey % 11 = 3 THEN 'value: customer_id'
                 WHEN o_orderkey % 13 = 5 THEN 'value: order_date' ELSE 'kept' END AS reason FROM orders)
    GROUP BY 1""",
    }
)
ORACLES["mart_roundtrip"] = (
    f"SELECT m.*, d.text FROM ({ORACLES['mart_fact_feedback']}) m LEFT JOIN documents d ON d.doc_id = m.feedback_id"
)
