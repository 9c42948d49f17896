"""The registered jobs' results in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from offerwise.registry.inputs import AS_OF
from offerwise.registry.pricing_queries import CALIBRATED

# Each step of the shared derivation; `_sql` puts the needed ones in front of a query.
STEPS = {
    "per_order": """
        select l_orderkey, max(l_quantity) as top_quantity, count(*) as line_count,
               count(*) filter (where l_returnflag = 'R') as returned,
               count(*) filter (where l_linestatus = 'O') as open_lines,
               min(p_name) as productname
        from lineitem left join part on l_partkey = p_partkey
        group by l_orderkey""",
    "subscribed": """
        select *, case o_orderpriority when '1-URGENT' then 30 when '2-HIGH' then 60
                       when '3-MEDIUM' then 90 when '4-NOT SPECIFIED' then 180
                       else 365 end as days
        from orders left join per_order on o_orderkey = l_orderkey""",
    "purchase_log": """
        select o_custkey as username, o_orderkey as purchaseid,
               cast(o_orderdate as date) as purchasedate,
               cast(o_orderdate as date) + days as expirationdate,
               cast(o_totalprice as decimal(18, 2)) as price,
               cast(days as integer) as duration,
               cast(if(coalesce(top_quantity, 0) >= 40, 100, 50) as integer) as bandwidth,
               cast(if(coalesce(line_count, 0) >= 5, 1, 0) as integer) as gig_product,
               productname,
               cast(coalesce(returned, 0) as bigint) as supportcallcount,
               cast(coalesce(open_lines, 0) as bigint) as disruptioncount,
               cast(if(coalesce(productname, '') like '%ring%', 1, 0) as integer)
                   as has_static_ip
        from subscribed""",
    "priced": """
        select *, max(price) over (
                      partition by year(purchasedate), month(purchasedate), duration,
                                   bandwidth, gig_product, has_static_ip) as top_price,
               if(duration > 0, cast(price as double) / duration, 0) as arpu
        from purchase_log""",
    "neighbours": """
        select *, row_number() over seen as nth,
               sum(price) over (seen rows between unbounded preceding and 1 preceding)
                   as spent_before,
               lead(purchasedate) over seen as next_date,
               lead(price) over seen as next_price,
               lead(duration) over seen as next_duration,
               lead(arpu) over seen as next_arpu,
               lag(price) over seen as prev_price,
               lag(duration) over seen as prev_duration,
               lag(arpu) over seen as prev_arpu,
               lag(expirationdate) over seen as prev_expiry,
               lag(supportcallcount) over seen as prev_calls,
               avg(disruptioncount) over (seen rows between 3 preceding and 1 preceding)
                   as recent_disruptions
        from priced
        window seen as (partition by username
                        order by purchasedate nulls first, purchaseid nulls first)""",
    "judged": f"""
        select *, next_date - expirationdate as late,
               case when late <= 15 then if(next_arpu < arpu, 1, 0)
                    when late > 15 then 2
                    when expirationdate + 15 < date '{AS_OF}' then 2 end as action
        from neighbours""",
    "mart": """
        select username, purchaseid, purchasedate,
               cast(top_price as double) as catalog_price,
               cast(top_price - price as double) as hidden_discount_amount,
               if(top_price > 0, cast(top_price - price as double) / cast(top_price as double), 0)
                   as hidden_discount_percentage,
               duration, bandwidth, gig_product, has_static_ip,
               cast(nth as bigint) as purchase_sequence,
               cast(action as integer) as customer_action,
               arpu,
               cast(coalesce(spent_before, 0) as double) as cumulative_ltv,
               cast(purchasedate - prev_expiry as integer) as gap_days,
               arpu - coalesce(prev_arpu, 0) as arpu_trend,
               cast(supportcallcount - prev_calls as bigint) as supportcallcount_trend,
               recent_disruptions as rolling_3_disruptioncount
        from judged""",
    "cohort": "select * from mart where customer_action is not null",
    "today": """
        select *, 0.0002::double * arpu - 0.3::double as z1,
               0.0005::double * arpu + 0.0001::double * arpu_trend as z2
        from cohort""",
    "today_scored": """
        select *, exp(0 - greatest(0, z1, z2)) as w0, exp(z1 - greatest(0, z1, z2)) as w1,
               exp(z2 - greatest(0, z1, z2)) as w2,
               w0 / (w0 + w1 + w2) as p_accept, w1 / (w0 + w1 + w2) as p_downgrade,
               w2 / (w0 + w1 + w2) as p_churn
        from today""",
    "grid": """
        select cast(k as integer) as scenario_id, cast(5 * k as double) / 100::double as discount
        from range(7) as steps(k)""",
    "scenarios": """
        select c.* exclude (arpu, arpu_trend, hidden_discount_amount, hidden_discount_percentage),
               c.arpu as current_arpu, scenario_id, discount as simulated_discount,
               catalog_price * (1 - discount) as offered_price,
               catalog_price - offered_price as hidden_discount_amount,
               discount as hidden_discount_percentage,
               if(duration > 0, offered_price / duration, 0) as offered_arpu,
               offered_arpu - (c.arpu - c.arpu_trend) as offered_trend
        from cohort c, grid""",
    "scored": """
        select *, 0.0002::double * offered_arpu - 0.3::double as z1,
               0.0005::double * offered_arpu + 0.0001::double * offered_trend as z2,
               exp(0 - greatest(0, z1, z2)) as w0, exp(z1 - greatest(0, z1, z2)) as w1,
               exp(z2 - greatest(0, z1, z2)) as w2,
               w0 / (w0 + w1 + w2) as p_accept, w1 / (w0 + w1 + w2) as p_downgrade,
               w2 / (w0 + w1 + w2) as p_churn,
               p_accept * offered_price + p_downgrade * (offered_price * 0.7::double) as ev
        from scenarios""",
    "best": """
        select * from scored
        qualify row_number() over (
            partition by purchaseid order by ev desc nulls last, scenario_id) = 1""",
    "predicted": """
        select *, case when p_accept >= p_downgrade and p_accept >= p_churn then 0
                       when p_downgrade >= p_churn then 1 else 2 end as prediction
        from today_scored""",
    "outcomes": "select unnest([0, 1, 2]) as k",
    "per_class": """
        select k, count(*) filter (where customer_action = k) as support,
               count(*) filter (where prediction = k) as said,
               count(*) filter (where customer_action = k and prediction = k) as hit
        from outcomes, predicted group by k""",
    "class_scores": """
        select k, support, coalesce(hit / nullif(said, 0), 0) as prec,
               coalesce(hit / nullif(support, 0), 0) as rec,
               coalesce(2 * hit / nullif(said + support, 0), 0) as f
        from per_class""",
    "targets": """
        select purchaseid, username as user_id,
               cast(trunc(current_arpu) as bigint) as current_arpu,
               cast(trunc(offered_arpu) as bigint) as offered_arpu,
               rolling_3_disruptioncount as recent_disruptions,
               cast(trunc(catalog_price) as bigint) as base_price,
               cast(5 * scenario_id as varchar) || '%' as recommended_discount,
               cast(trunc(offered_price) as bigint) as final_offer_price
        from best""",
    "profile": """
        select avg(catalog_price) as catalog_price,
               avg(hidden_discount_amount) as hidden_discount_amount,
               avg(hidden_discount_percentage) as hidden_discount_percentage,
               avg(duration) as duration, avg(bandwidth) as bandwidth,
               avg(gig_product) as gig_product, avg(has_static_ip) as has_static_ip,
               avg(purchase_sequence) as purchase_sequence, avg(arpu) as arpu,
               avg(cumulative_ltv) as cumulative_ltv, avg(gap_days) as gap_days,
               avg(arpu_trend) as arpu_trend,
               avg(supportcallcount_trend) as supportcallcount_trend,
               max(rolling_3_disruptioncount) as rolling_3_disruptioncount
        from cohort""",
}

NEEDS = {
    "per_order": [],
    "subscribed": ["per_order"],
    "purchase_log": ["subscribed"],
    "priced": ["purchase_log"],
    "neighbours": ["priced"],
    "judged": ["neighbours"],
    "mart": ["judged"],
    "cohort": ["mart"],
    "today": ["cohort"],
    "today_scored": ["today"],
    "grid": [],
    "scenarios": ["cohort", "grid"],
    "scored": ["scenarios"],
    "best": ["scored"],
    "predicted": ["today_scored"],
    "outcomes": [],
    "per_class": ["outcomes", "predicted"],
    "class_scores": ["per_class"],
    "targets": ["best"],
    "profile": ["cohort"],
}


def _sql(query: str, *steps: str, extra: dict[str, str] | None = None) -> str:
    ordered: list[str] = []

    def add(step: str) -> None:
        for needed in NEEDS[step]:
            add(needed)
        if step not in ordered:
            ordered.append(step)

    for step in steps:
        add(step)
    parts = [(s, STEPS[s]) for s in ordered] + list((extra or {}).items())
    ctes = ",\n".join(f"{name} as ({body})" for name, body in parts)
    return f"with {ctes}\n{query}"


def _policy(best_discounts: str) -> str:
    return f"""
        select count(*) as users,
               count(*) filter (where p_churn > 0.5) as threshold_discounts,
               round(100.0 * threshold_discounts / users, 6)::double as threshold_rate,
               count(*) filter (where d > 0) as value_discounts,
               round(100.0 * value_discounts / users, 6)::double as value_rate,
               round(100 * coalesce(avg(d) filter (where d > 0), 0), 6)::double
                   as value_mean_discount,
               threshold_discounts - value_discounts as discounts_saved
        from today_scored t join ({best_discounts}) using (purchaseid)"""


STATIC_VALUES = """
    select t.purchaseid, scenario_id, discount as d,
           p_accept as a, p_downgrade as b, catalog_price * (1 - discount) as offer
    from today_scored t, grid"""
RESCORED_VALUES = """
    select purchaseid, scenario_id, simulated_discount as d,
           p_accept as a, p_downgrade as b, offered_price as offer
    from scored"""


def _sensitivity(*steps: str, values: str) -> str:
    extra = {
        "vals": values,
        "alphas": "select cast(k as double) / 10 as alpha from range(4, 10) as r(k)",
        "per_user": """
            select alpha, purchaseid, max(a * offer + b * offer * alpha) as top,
                   sum(a * offer + b * offer * alpha) filter (where scenario_id = 3) as flat,
                   sum(a * offer + b * offer * alpha) filter (where scenario_id = 0) as plain
            from vals, alphas group by alpha, purchaseid""",
    }
    return _sql(
        """select alpha, round(sum(top), 2) as dynamic_value, round(sum(flat), 2) as flat_value,
                  round(sum(plain), 2) as undiscounted_value
           from per_user group by alpha""",
        *steps,
        extra=extra,
    )


def _elasticity(arpu: str, trend: str) -> str:
    extra = {
        "wide": """
            select cast(k as integer) as scenario_id,
                   cast(5 * k as double) / 100::double as simulated_discount
            from range(9) as steps(k)""",
        "quotes": f"""
            select scenario_id, simulated_discount,
                   100000::double * (1 - simulated_discount) as offered_price,
                   {arpu} as a, {trend} as t
            from profile, wide""",
        "curve": """
            select *, 0.0002::double * a - 0.3::double as z1,
                   0.0005::double * a + 0.0001::double * t as z2,
                   exp(0 - greatest(0, z1, z2)) as w0, exp(z1 - greatest(0, z1, z2)) as w1,
                   exp(z2 - greatest(0, z1, z2)) as w2, w0 + w1 + w2 as w,
                   w0 / w * offered_price + w1 / w * (offered_price * 0.7::double) as ev
            from quotes""",
    }
    return _sql(
        """select scenario_id, simulated_discount, offered_price,
                  round(w0 / w, 6) as p_accept, round(w1 / w, 6) as p_downgrade,
                  round(w2 / w, 6) as p_churn, round(ev, 2) as expected_value,
                  row_number() over (order by ev desc, scenario_id) = 1 as is_best
           from curve""",
        "profile",
        extra=extra,
    )


ROUNDTRIP = "select * from mart"
OFFERS = """
    select purchaseid, scenario_id, simulated_discount, offered_price, offered_arpu as arpu,
           round(ev, 2) as expected_value
    from best"""
FEATURE_LIST = """purchaseid, catalog_price, hidden_discount_amount, hidden_discount_percentage,
    duration, bandwidth, gig_product, has_static_ip, purchase_sequence, customer_action, arpu,
    cumulative_ltv, gap_days, arpu_trend, supportcallcount_trend, rolling_3_disruptioncount"""
BUCKET = "((purchaseid % 1000003) * 7919 + 42) % 10000"
DEPENDENCE = {
    "points": """
        select cast(k as integer) as point, cast(1000 * k as double) as value
        from range(21) as r(k)""",
    "at_points": """
        select point, value, 0.0002::double * value - 0.3::double as z1,
               0.0005::double * value + 0.0001::double * arpu_trend as z2,
               exp(z2 - greatest(0, z1, z2))
               / (exp(0 - greatest(0, z1, z2)) + exp(z1 - greatest(0, z1, z2))
                  + exp(z2 - greatest(0, z1, z2))) as churn
        from cohort, points""",
    "dependence": """
        select 'fixed' as model, point, value, avg(churn) as mean_churn, count(*) as rows
        from at_points group by point, value""",
}

ORACLES: dict[str, str] = {
    "q_staging": _sql(
        "select * exclude (price), cast(price as double) as price from purchase_log",
        "purchase_log",
    ),
    "q_catalog_price": _sql(
        "select username, purchaseid, cast(top_price as double) as catalog_price from priced",
        "priced",
    ),
    "q_purchase_sequence_ltv": _sql(
        "select username, purchaseid, purchase_sequence, cumulative_ltv from mart", "mart"
    ),
    "q_lead_lag": _sql(
        """select username, purchaseid, next_date as next_purchasedate,
                  cast(next_price as double) as next_price, next_duration,
                  cast(prev_price as double) as prev_price, prev_duration,
                  prev_expiry as prev_expirationdate, prev_calls as prev_supportcallcount
           from neighbours""",
        "neighbours",
    ),
    "q_gap_days": _sql(
        "select username, purchaseid, gap_days, supportcallcount_trend from mart", "mart"
    ),
    "q_rolling_disruptions": _sql(
        "select username, purchaseid, rolling_3_disruptioncount from mart", "mart"
    ),
    "q_hidden_discount": _sql(
        """select username, purchaseid, hidden_discount_amount, hidden_discount_percentage
           from mart""",
        "mart",
    ),
    "q_arpu_trend": _sql("select username, purchaseid, arpu, arpu_trend from mart", "mart"),
    "q_customer_action": _sql("select username, purchaseid, customer_action from mart", "mart"),
    "q_mart": _sql(ROUNDTRIP, "mart"),
    "q_training_set": _sql(f"select {FEATURE_LIST} from cohort", "cohort"),
    "q_class_distribution": _sql(
        """select customer_action, count(*) as n,
                  round(100.0 * count(*) / sum(count(*)) over (), 6)::double as share_percent
           from cohort group by customer_action""",
        "cohort",
    ),
    "q_class_weights": _sql(
        """select purchaseid, customer_action,
                  round(count(*) over () / (3.0::double * count(*) over (partition by
                  customer_action)), 9) as class_weight
           from cohort""",
        "cohort",
    ),
    "q_profile_counts": _sql(
        "select count(*) as rows, cast(15 as integer) as columns from cohort", "cohort"
    ),
    "q_binary_label": _sql(
        "select purchaseid, cast(customer_action = 2 as integer) as churned from cohort",
        "cohort",
    ),
    "q_split_bucket": _sql(
        f"select purchaseid, customer_action, {BUCKET} < 7000 as in_train from cohort", "cohort"
    ),
    "q_stratified_split": _sql(
        f"""select purchaseid, customer_action,
                   row_number() over (partition by customer_action order by {BUCKET}, purchaseid)
                   <= round(0.8 * count(*) over (partition by customer_action)) as in_train
            from cohort""",
        "cohort",
    ),
    "q_cohort_csv": _sql(
        """select purchaseid, username, catalog_price, arpu, arpu_trend, duration,
                  rolling_3_disruptioncount
           from cohort""",
        "cohort",
    ),
    "q_scenarios": _sql(
        """select purchaseid, scenario_id, simulated_discount, offered_price,
                  hidden_discount_amount, hidden_discount_percentage, offered_arpu as arpu,
                  offered_trend as arpu_trend
           from scenarios""",
        "scenarios",
    ),
    "q_scores": _sql(
        """select purchaseid, scenario_id, round(p_accept, 6) as p_accept,
                  round(p_downgrade, 6) as p_downgrade, round(p_churn, 6) as p_churn
           from scored""",
        "scored",
    ),
    "q_expected_value": _sql(
        "select purchaseid, scenario_id, round(ev, 2) as expected_value from scored", "scored"
    ),
    "q_flat_discount": _sql(
        """select if(scenario_id = 0, 'none', 'flat') as scenario, count(*) as customers,
                  round(sum(ev), 2) as total_value
           from scored where scenario_id in (0, 3) group by scenario_id""",
        "scored",
    ),
    "q_optimal_discount": _sql(OFFERS, "best"),
    "q_discount_distribution": _sql(
        """select simulated_discount, count(*) as n,
                  round(100.0 * count(*) / sum(count(*)) over (), 6)::double as share_percent,
                  cast(5 * scenario_id as varchar) || '%' as discount
           from best group by simulated_discount, scenario_id""",
        "best",
    ),
    "q_target_list": _sql("select * from targets", "targets"),
    "q_target_preview": _sql(
        "select * from targets order by purchaseid limit 15", "targets"
    ),
    "q_ev_curve": _sql(
        """select purchaseid, scenario_id, simulated_discount, offered_price,
                  round(ev, 2) as expected_value
           from scored""",
        "scored",
    ),
    "q_strategy_comparison": _sql(
        _policy(
            """select purchaseid, d from vals qualify row_number() over (
                   partition by purchaseid
                   order by a * offer + b * (offer * 0.7::double) desc, scenario_id) = 1"""
        ),
        "today_scored",
        "grid",
        extra={"vals": STATIC_VALUES},
    ),
    "q_strategy_comparison_rescored": _sql(
        _policy("select purchaseid, simulated_discount as d from best"), "today_scored", "best"
    ),
    "q_alpha_sensitivity_static": _sensitivity("today_scored", "grid", values=STATIC_VALUES),
    "q_alpha_sensitivity_rescored": _sensitivity("scored", values=RESCORED_VALUES),
    "q_elasticity_curve": _elasticity(
        "if(duration > 0, offered_price / duration, 0)",
        "if(duration > 0, offered_price / duration, 0) - (arpu - -50::double)",
    ),
    "q_elasticity_curve_quoted": _elasticity("offered_price", "-50::double"),
    "q_mean_profile": _sql(
        "select " + ", ".join(
            f"round({c}, 4) as {c}"
            for c in """catalog_price hidden_discount_amount hidden_discount_percentage duration
                bandwidth gig_product has_static_ip purchase_sequence arpu cumulative_ltv gap_days
                arpu_trend supportcallcount_trend rolling_3_disruptioncount""".split()
        ) + " from profile",
        "profile",
    ),
    "q_hard_predictions": _sql(
        "select purchaseid, customer_action, cast(prediction as integer) as prediction "
        "from predicted",
        "predicted",
    ),
    "q_confusion": _sql(
        """select customer_action, cast(prediction as integer) as prediction, count(*) as n
           from predicted group by customer_action, prediction""",
        "predicted",
    ),
    "q_class_report": _sql(
        """select case k when 0 then 'accept' when 1 then 'downgrade' else 'churn' end as class,
                  round(prec, 6) as precision, round(rec, 6) as recall, round(f, 6) as f1,
                  support
           from class_scores
           union all
           select 'accuracy', round(a, 6), round(a, 6), round(a, 6), n
           from (select avg(cast(customer_action = prediction as integer)) as a, count(*) as n
                 from predicted)
           union all
           select 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f), 6),
                  cast(sum(support) as bigint)
           from class_scores
           union all
           select 'weighted avg', round(sum(prec * support) / sum(support), 6),
                  round(sum(rec * support) / sum(support), 6),
                  round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint)
           from class_scores""",
        "class_scores",
    ),
    "q_log_loss": _sql(
        """select round(avg(-ln(least(greatest(
                      case customer_action when 0 then p_accept when 1 then p_downgrade
                           else p_churn end, 1e-15), 1 - 1e-15))), 6) as log_loss,
                  (select round(avg(f), 6) from class_scores) as macro_f1
           from predicted""",
        "class_scores",
    ),
    "q_metric_improvement": _sql(
        """select round(100 * (ln(3) - loss) / ln(3), 4) as log_loss_gain,
                  round(100 * (f1 - base_f1) / base_f1, 4) as macro_f1_gain
           from (select avg(-ln(least(greatest(
                            case customer_action when 0 then p_accept when 1 then p_downgrade
                                 else p_churn end, 1e-15), 1 - 1e-15))) as loss,
                        (select avg(f) from class_scores) as f1,
                        2.0::double * count(*) filter (where customer_action = 0)
                        / (count(*) + count(*) filter (where customer_action = 0)) / 3
                            as base_f1
                 from predicted)""",
        "class_scores",
    ),
    "q_partial_dependence": _sql(
        "select model, point, value, round(mean_churn, 6) as mean_churn, rows from dependence",
        "cohort",
        extra=DEPENDENCE,
    ),
    "q_constraint_steps": _sql(
        """select model, count(*) as points, count(*) filter (where s < -1e-12) as falling_steps,
                  round(coalesce(max(-s) filter (where s < -1e-12), 0), 6) as largest_fall
           from (select model, mean_churn - lag(mean_churn) over (order by point) as s
                 from dependence)
           group by model""",
        "cohort",
        extra=DEPENDENCE,
    ),
    "q_external_adapter": _sql(
        """select "customerID", cast("TotalCharges" as double) as "TotalCharges",
                  "MonthlyCharges", cast(dense_rank() over (order by "Contract") - 1 as integer) as "Contract",
                  cast(dense_rank() over (order by "Segment") - 1 as integer) as "Segment", "Churn",
                  case when "Churn" = 'Yes' then 2 when "Contract" = 'Month-to-month' then 1
                       else 0 end as customer_action,
                  round("MonthlyCharges" * 1.15, 4) as catalog_price, "MonthlyCharges" as arpu
           from kept""",
        extra={
            "export": """
                select cast(c_custkey as varchar) as "customerID",
                       if(c_custkey % 10 = 0, null, c_acctbal) as "TotalCharges",
                       if(c_custkey % 17 <> 0, c_acctbal, null) as "MonthlyCharges",
                       if(c_custkey % 3 = 0, 'Month-to-month', 'One year') as "Contract",
                       c_mktsegment as "Segment",
                       if(c_acctbal < 2500, 'Yes', 'No') as "Churn"
                from customer""",
            "kept": """
                select * from export
                where "TotalCharges" is not null and "MonthlyCharges" is not null
                  and "Segment" is not null""",
        },
    ),
}

# Other ways to the same result.
ORACLES |= {
    "q_staging_hot_parts": ORACLES["q_staging"],
    "q_external_csv": ORACLES["q_external_adapter"],
    "q_catalog_price_many_cells": ORACLES["q_catalog_price"],
    "q_mart_split_history": ORACLES["q_mart"],
    "q_mart_parquet_roundtrip": ORACLES["q_mart"],
    "q_mart_csv_roundtrip": ORACLES["q_mart"],
    "q_optimal_discount_unrolled": ORACLES["q_optimal_discount"],
    "q_target_list_csv": ORACLES["q_target_list"],
}


# --- what the check queries must give ----------------------------------------------------


def _group_shares(a: str, b: str, c: str) -> str:
    return f"""select has_static_ip, round({a}, 3)::double as p_accept,
                      round({b}, 3)::double as p_downgrade, round({c}, 3)::double as p_churn
               from counted"""


_COUNTED = {
    "sizes": """
        select *, count(*) over () / (3.0::double * count(*) over (partition by
               customer_action)) as w
        from cohort""",
    "counted": """
        select has_static_ip, count(*)::double as n, sum(w) as wn,
               count(*) filter (where customer_action = 0) as n0,
               count(*) filter (where customer_action = 1) as n1,
               count(*) filter (where customer_action = 2) as n2,
               sum(w) filter (where customer_action = 0) as w0,
               sum(w) filter (where customer_action = 1) as w1,
               sum(w) filter (where customer_action = 2) as w2,
               1 / (1 + exp(-2 * (2 * n0 / n - 1))) as g0,
               1 / (1 + exp(-2 * (2 * n1 / n - 1))) as g1,
               1 / (1 + exp(-2 * (2 * n2 / n - 1))) as g2
        from sizes group by has_static_ip""",
}
_NO_FAULT = """select count(*) as rows, 0::bigint as sums_off_one, 0 as wrong_signs,
                      0::bigint as falling_steps
               from cohort"""
_EXPORT = {
    "export": """
        select cast(c_custkey as varchar) as "customerID", c_acctbal as charge,
               if(c_custkey % 3 = 0, 'Month-to-month', 'One year') as "Contract"
        from customer
        where c_custkey % 10 <> 0 and c_custkey % 17 <> 0 and c_acctbal is not null
          and c_mktsegment is not null""",
}


def _uniform(salt: int) -> str:
    return (
        f"""((('0x' || substr(md5("customerID" || '|42|{salt}'), 1, 12))::bigint + 0.5::double)"""
        " / 281474976710656::double)"
    )


_GAPS = {
    "holed": """
        select purchaseid % 2 = 1 as odd,
               odd and (purchaseid % 5 = 0 or purchaseid % 11 = 0) as broken,
               if(purchaseid % 7 <> 0, customer_action, null) as label, p_accept, p_downgrade, p_churn
        from today_scored""",
    "weighed": """
        select label, count(*) as k,
               sum(count(*)) over () / (3.0::double * count(*)) as class_weight
        from holed where label is not null group by label""",
}

ORACLES |= {
    "q_sample": _sql(
        """select * from cohort order by md5(cast(purchaseid as varchar) || '|42'), purchaseid
           limit 2000""",
        "cohort",
    ),
    "q_sample_digest": _sql(
        """select purchaseid, customer_action from cohort
           order by md5(cast(purchaseid as varchar) || '|42'), purchaseid limit 500""",
        "cohort",
    ),
    "q_logistic_shares": _sql(
        _group_shares("n0 / n", "n1 / n", "n2 / n"), "cohort", extra=_COUNTED
    ),
    "q_weighted_shares": _sql(
        _group_shares("w0 / wn", "w1 / wn", "w2 / wn"), "cohort", extra=_COUNTED
    ),
    "q_boosted_shares": _sql(
        _group_shares("g0 / (g0 + g1 + g2)", "g1 / (g0 + g1 + g2)", "g2 / (g0 + g1 + g2)"),
        "cohort",
        extra=_COUNTED,
    ),
    "q_churn_shares": _sql(
        "select has_static_ip, round(n2 / n, 3)::double as churn_risk from counted",
        "cohort",
        extra=_COUNTED,
    ),
    "q_constrained_faults": _sql(_NO_FAULT, "cohort"),
    "q_retrained_faults": _sql(_NO_FAULT, "cohort"),
    "q_audit_faults": "select 'constrained' as model, 0::bigint as falling_steps",
    "q_saved_model_faults": _sql("select count(*) as rows, 0::bigint as differing from cohort", "cohort"),
    "q_search_faults": _sql(
        """select 15 as draws, 15 as distinct_draws, 0 as outside_space,
                  0 as better_than_chosen, count(*) as rows
           from cohort""",
        "cohort",
    ),
    "q_train_supports": _sql(
        """select ['accept', 'downgrade', 'churn'][customer_action + 1] as "class",
                  cast(count(*) - round(0.8 * count(*)) as bigint) as support
           from cohort group by customer_action""",
        "cohort",
    ),
    "q_ablation_faults": _sql(
        "select count(*) as rows, 2 as models, 0 as gains_off from cohort", "cohort"
    ),
    "q_external_noise": _sql(
        f"""select "customerID",
                   round(sqrt(-2 * ln({_uniform(1)})) * cos(2 * pi() * {_uniform(2)}) * 5, 6)
                       as arpu_trend
            from export""",
        extra=_EXPORT,
    ),
    "q_external_policy_fixed": _sql(
        """select count(distinct "customerID") as users,
                  count(*) filter (where k = 0 and c0 > 0.5) as threshold_discounts,
                  count(*) filter (where top = 1 and d > 0) as value_discounts
           from ranked""",
        extra=_EXPORT
        | {
            "offers": """
                select *, cast(5 * k as double) / 100 as d, charge * 1.15 as price,
                       price * (1 - d) as offer, offer as a, offer - charge as t,
                       0.0002::double * charge - 0.3 as y1, 0.0005::double * charge as y2,
                       exp(y2) / (1 + exp(y1) + exp(y2)) as c0,
                       0.0002::double * a - 0.3 as z1, 0.0005::double * a + 0.0001::double * t as z2,
                       1 + exp(z1) + exp(z2) as s,
                       offer / s + exp(z1) / s * (offer * 0.7::double) as ev
                from export, range(7) as steps(k)""",
            "ranked": """
                select *, row_number() over (partition by "customerID"
                                             order by if(ev > -1, ev, null) desc nulls last, k) as top
                from offers""",
        },
    ),
    "q_external_encode_wide": """
        select c_custkey, cast(dense_rank() over (order by c_name) - 1 as integer) as c_name,
               cast(dense_rank() over (order by c_mktsegment) - 1 as integer) as c_mktsegment
        from customer""",
    "q_staging_missing_parts": """
        with lines as (
            select l_orderkey, l_quantity, l_returnflag,
                   if(l_orderkey % 3 = 2, l_partkey, null) as partkey
            from lineitem),
        per_order as (
            select l_orderkey, min(p_name) as productname, max(l_quantity) as q, count(*) as n,
                   count(*) filter (where l_returnflag = 'R') as r
            from lines left join part on partkey = p_partkey group by l_orderkey)
        select o_orderkey as purchaseid, productname,
               cast(if(coalesce(q, 0) >= 40, 100, 50) as integer) as bandwidth,
               cast(if(coalesce(n, 0) >= 5, 1, 0) as integer) as gig_product,
               cast(coalesce(r, 0) as bigint) as flowcount
        from orders left join per_order on o_orderkey = l_orderkey""",
    "q_cohort_csv_minimum": _sql(
        """select count(*) as rows, count(*) as row_ids, round(sum(arpu), 2) as arpu,
                  round(sum(arpu_trend), 2) as arpu_trend,
                  round(sum(catalog_price), 2) as catalog_price,
                  cast(sum(duration) as bigint) as duration, count(distinct username) as usernames
           from cohort""",
        "cohort",
    ),
    "q_mart_csv_optional_columns": _sql(
        """select purchaseid, 'p' || (username % 5) as province, 'a' as salesagent,
                  catalog_price as actual_paid_price, 'n' as note, catalog_price,
                  customer_action, gap_days
           from mart""",
        "mart",
    ),
    "q_scores_missing_feature": _sql(
        """select purchaseid, round(1 / s, 6) as p_accept, round(exp(z1) / s, 6) as p_downgrade,
                  round(exp(y2) / s, 6) as p_churn
           from (select purchaseid, z1, 0.0005::double * arpu as y2, 1 + exp(z1) + exp(y2) as s
                 from today)""",
        "today",
    ),
    "q_alpha_sensitivity_off_grid": _sql(
        """select alpha, round(sum(top), 2) as dynamic_value, round(sum(flat), 2) as flat_value,
                  round(sum(plain), 2) as undiscounted_value
           from (select alpha, purchaseid, max(v) filter (where not off) as top,
                        sum(v) filter (where off) as flat,
                        sum(v) filter (where d = 0) as plain
                 from (select *, a * offer + b * offer * alpha as v from vals, alphas)
                 group by alpha, purchaseid)
           group by alpha""",
        "cohort",
        extra={
            "alphas": "select cast(k as double) / 10 as alpha from range(4, 10) as r(k)",
            "offered": """
                select purchaseid, d, d = 0.12::double as off, catalog_price * (1 - d) as offer,
                       if(duration > 0, offer / duration, 0) as u, u - (arpu - arpu_trend) as t,
                       0.0002::double * u - 0.3::double as z1,
                       0.0005::double * u + 0.0001::double * t as z2
                from cohort, (select unnest([0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.12])::double as d)""",
            "vals": """
                select purchaseid, d, off, offer, 1 / (1 + exp(z1) + exp(z2)) as a,
                       1 / (1 + exp(0 - z1) + exp(z2 - z1)) as b
                from offered""",
        },
    ),
    "q_metrics_with_gaps": _sql(
        """select odd, count(*) as rows,
                  if(odd, null, round(avg(-ln(least(greatest(case label when 0 then p_accept
                         when 1 then p_downgrade when 2 then p_churn end, 1e-15), 1 - 1e-15)))
                         filter (where label is not null), 6))
                      as log_loss,
                  count(*) filter (where not broken) as predicted,
                  count(class_weight) as weighted, round(sum(class_weight), 4) as weight
           from holed left join weighed using (label) group by odd""",
        "today_scored",
        extra=_GAPS,
    ),
}
ORACLES |= {
    "q_forest_shares": _sql(
        _group_shares("n0 / n", "n1 / n", "n2 / n"),
        "cohort",
        extra={
            "sizes": _COUNTED["sizes"],
            "likeliest": """
                select count(distinct top) = 1 as alike from (
                    select has_static_ip, arg_max(customer_action, (k, -customer_action)) as top
                    from (select has_static_ip, customer_action, count(*) as k from cohort
                          group by all)
                    group by has_static_ip)""",
            "leaves": """
                select has_static_ip, if(alike, 0, has_static_ip) as leaf, customer_action
                from cohort, likeliest""",
            "counted": """
                select has_static_ip, n, n0, n1, n2
                from (select leaf, count(*)::double as n,
                             count(*) filter (where customer_action = 0) as n0,
                             count(*) filter (where customer_action = 1) as n1,
                             count(*) filter (where customer_action = 2) as n2
                      from leaves group by leaf)
                join (select distinct has_static_ip, leaf from leaves) using (leaf)""",
        },
    ),
    "q_read_purchases": ORACLES["q_staging"],
}


# --- envelopes, monotone and calibrated scores, attributions -------------------------------

_ROUGH = {
    "rough": """
        select purchaseid, catalog_price, scenario_id, discount,
               ((purchaseid * 7 + 5 * scenario_id * 13) % 10) / 20.0::double as churn
        from cohort, grid""",
    # From the lowest price, which is the last scenario, to the highest.
    "means": """
        select a.purchaseid, a.scenario_id as first, b.scenario_id as last,
               avg(m.churn) as mean
        from rough a join rough b on a.purchaseid = b.purchaseid and b.scenario_id <= a.scenario_id
        join rough m on m.purchaseid = a.purchaseid
             and m.scenario_id between b.scenario_id and a.scenario_id
        group by all""",
    "least_means": """
        select r.purchaseid, r.scenario_id, m.first, min(mean) as mean
        from rough r join means m on m.purchaseid = r.purchaseid
             and m.first >= r.scenario_id and m.last <= r.scenario_id
        group by all""",
    "pooled": """
        select purchaseid, scenario_id, max(mean) as churn from least_means group by all""",
    "evened": """
        select purchaseid, scenario_id, (1 - p.churn) * 0.75::double as a,
               (1 - p.churn) * 0.25::double as b, p.churn as c, catalog_price * (1 - discount) as offer
        from pooled p join rough r using (purchaseid, scenario_id)""",
}


def _curve(score: str, x: tuple[float, ...], y: tuple[float, ...]) -> str:
    """SQL of the line through knots, level outside them."""
    cases = [f"when {score} <= {x[0]}::double then {y[0]}::double"]
    for x0, x1, y0, y1 in zip(x, x[1:], y, y[1:], strict=False):
        along = f"({score} - {x0}::double) / ({x1}::double - {x0}::double)"
        cases.append(f"when {score} < {x1}::double then {y0}::double + ({y1 - y0!r}::double) * {along}")
    return f"case {' '.join(cases)} else {y[-1]}::double end"


def _calibrated(arpu: str, trend: str, source: str) -> dict[str, str]:
    """Steps from features to the calibrated probabilities p0, p1 and p2 of registry.pricing_queries."""
    margins, scores, values, means = [], [], [], []
    for f, (fold, curves) in enumerate(zip(CALIBRATED.folds, CALIBRATED.curves, strict=True)):
        for k in range(3):
            w = fold.coefficients[k]
            margins.append(
                f"{fold.intercepts[k]}::double + {w[0]}::double * {arpu} + {w[1]}::double * {trend} as z{f}{k}"
            )
            others = " + ".join(f"exp(z{f}{j} - z{f}{k})" for j in range(3))
            scores.append(f"1 / ({others}) as s{f}{k}")
            values.append(f"{_curve(f's{f}{k}', curves[k].x, curves[k].y)} as v{f}{k}")
    for k in range(3):
        shares = [
            f"if(v{f}0 + v{f}1 + v{f}2 > 0, v{f}{k} / (v{f}0 + v{f}1 + v{f}2), 1 / 3::double)"
            for f in range(len(CALIBRATED.folds))
        ]
        means.append(f"({' + '.join(shares)}) / {len(CALIBRATED.folds)} as p{k}")
    return {
        "margins": f"select *, {', '.join(margins)} from {source}",
        "raw_scores": f"select *, {', '.join(scores)} from margins",
        "curved": f"select *, {', '.join(values)} from raw_scores",
        "calibrated": f"select *, {', '.join(means)} from curved",
    }


_ATTRIBUTION = {
    "center": "select avg(arpu) as ma, avg(arpu_trend) as mt from cohort",
    "parts": """
        select purchaseid, 'arpu' as feature, arpu as value, 0::double as accept,
               0.0002::double * (arpu - ma) as downgrade, 0.0005::double * (arpu - ma) as churn
        from cohort, center
        union all
        select purchaseid, 'arpu_trend', arpu_trend, 0, 0, 0.0001::double * (arpu_trend - mt)
        from cohort, center""",
}

# Shares of rows, as a calibrated model of one binary feature gives them; folds by arithmetic.
_FOLD = "((purchaseid % 1000003) * 7919 + 7) % 3"
_CROSS_FITTED = {
    "folds": f"select has_static_ip as g, {_FOLD} as fold, customer_action as action from cohort",
    "numbers": "select unnest([0, 1, 2]) as f",
    "fitted": """
        select f, k, g, avg(cast(action = k as integer)) filter (where fold <> f) as score,
               avg(cast(action = k as integer)) filter (where fold = f) as share,
               count(*) filter (where fold = f) as n
        from folds, numbers, outcomes group by all""",
    "paired": """
        select a.f, a.k, a.g, a.share, (a.score < b.score) = (a.share < b.share) as rises,
               (a.share * a.n + b.share * b.n) / (a.n + b.n) as pooled
        from fitted a join fitted b on a.f = b.f and a.k = b.k and a.g <> b.g""",
    "curves": "select f, k, g, if(rises, share, pooled) as value from paired",
    "normalised": "select k, g, value / sum(value) over (partition by f, g) as p from curves",
    "averaged": "select k, g, round(avg(p), 3)::double as p from normalised group by k, g",
}


def _boosted(k: int) -> str:
    """Margin of outcome k after the default number of boosting steps on one binary feature."""
    return f"""
        select g, s, 2 * s - 1 as f, 1 as step
        from (select has_static_ip as g, avg(cast(customer_action = {k} as integer)) as s
              from cohort group by has_static_ip)
        union all
        select g, s, f + 0.1::double * (s * 4 / (1 + exp(2 * f)) - (1 - s) * 4 / (1 + exp(-2 * f))), step + 1
        from boost{k} where step < 20"""


def _recursive(query: str, ks: tuple[int, ...]) -> str:
    made = _sql(query, "cohort", extra={f"boost{k}": _boosted(k) for k in ks})
    return made.replace("with ", "with recursive ", 1)


ORACLES |= {
    "q_alpha_envelope_static": ORACLES["q_alpha_sensitivity_static"],
    "q_alpha_envelope_rescored": ORACLES["q_alpha_sensitivity_rescored"],
    "q_alpha_envelope_off_grid": ORACLES["q_alpha_sensitivity_off_grid"],
    "q_alpha_envelope_fine": _sql(
        """select alpha, round(sum(greatest(a0 + alpha * b0, a1 + alpha * b1, a2 + alpha * b2,
                      a3 + alpha * b3, a4 + alpha * b4, a5 + alpha * b5, a6 + alpha * b6)), 1)
                      as dynamic_value
           from wide, alphas group by alpha""",
        "scored",
        extra={
            "alphas": "select cast(k as double) / 1000 as alpha from range(1000) as r(k)",
            "wide": "select purchaseid, "
            + ", ".join(
                f"max(p_accept * offered_price) filter (where scenario_id = {i}) as a{i},"
                f" max(p_downgrade * offered_price) filter (where scenario_id = {i}) as b{i}"
                for i in range(7)
            )
            + " from scored group by purchaseid",
        },
    ),
    "q_monotone_scores": _sql(
        """select purchaseid, scenario_id, round(a, 6) as p_accept, round(b, 6) as p_downgrade,
                  round(c, 6) as p_churn
           from evened""",
        "cohort",
        "grid",
        extra=_ROUGH,
    ),
    "q_monotone_offers": _sql(
        """select purchaseid, scenario_id, round(c, 6) as p_churn
           from evened
           qualify row_number() over (
               partition by purchaseid
               order by a * offer + b * (offer * 0.7::double) desc, scenario_id) = 1""",
        "cohort",
        "grid",
        extra=_ROUGH,
    ),
    "q_monotone_faults": _sql(
        """select unnest(['forest', 'boosted']) as family, count(*) as rows,
                  0::bigint as falling_steps, 0::bigint as sums_off_one
           from cohort""",
        "cohort",
    ),
    "q_calibrated_fixed_scores": _sql(
        """select purchaseid, round(p0, 6) as p_accept, round(p1, 6) as p_downgrade,
                  round(p2, 6) as p_churn
           from calibrated""",
        "cohort",
        extra=_calibrated("arpu", "arpu_trend", "cohort"),
    ),
    "q_calibrated_fixed_offers": _sql(
        """select purchaseid, scenario_id, round(p0, 6) as p_accept, round(p1, 6) as p_downgrade,
                  round(p2, 6) as p_churn,
                  round(p0 * offered_price + p1 * (offered_price * 0.7::double), 2) as expected_value
           from calibrated
           qualify row_number() over (
               partition by purchaseid
               order by p0 * offered_price + p1 * (offered_price * 0.7::double) desc, scenario_id) = 1""",
        "scenarios",
        extra=_calibrated("offered_arpu", "offered_trend", "scenarios"),
    ),
    "q_attribution": _sql(
        """select purchaseid, feature, round(value, 6) as value, round(accept, 6) as accept,
                  round(downgrade, 6) as downgrade, round(churn, 6) as churn
           from parts""",
        "cohort",
        extra=_ATTRIBUTION,
    ),
    "q_attribution_importance": _sql(
        """select feature, round(avg(abs(accept)), 6) as accept,
                  round(avg(abs(downgrade)), 6) as downgrade, round(avg(abs(churn)), 6) as churn
           from parts group by feature""",
        "cohort",
        extra=_ATTRIBUTION,
    ),
    "q_attribution_reasons": _sql(
        """select purchaseid, coalesce(string_agg(feature, ',' order by accept - churn, feature)
                                       filter (where churn > accept), '') as reasons
           from parts group by purchaseid""",
        "cohort",
        extra=_ATTRIBUTION,
    ),
    "q_attribution_faults": _sql(
        "select count(*) as rows, 0::bigint as off, 14 * count(*) as parts from cohort", "cohort"
    ),
    "q_calibrated_shares": _sql(
        """select g as has_static_ip, max(p) filter (where k = 0) as p_accept,
                  max(p) filter (where k = 1) as p_downgrade, max(p) filter (where k = 2) as p_churn
           from averaged group by g""",
        "cohort",
        "outcomes",
        extra=_CROSS_FITTED,
    ),
    "q_calibrated_faults": _sql("select count(*) as rows, 0::bigint as differing from cohort", "cohort"),
    "q_saved_calibrated_faults": _sql(
        "select count(*) as rows, 0::bigint as differing from cohort", "cohort"
    ),
    "q_boosted_churn_shares": _recursive(
        """select g as has_static_ip, round(1 / (1 + exp(-2 * f)), 3)::double as churn_risk
           from boost2 where step = 20""",
        (2,),
    ),
    "q_boosted_default_shares": _recursive(
        """select g as has_static_ip, round(p0 / (p0 + p1 + p2), 3)::double as p_accept,
                  round(p1 / (p0 + p1 + p2), 3)::double as p_downgrade,
                  round(p2 / (p0 + p1 + p2), 3)::double as p_churn
           from (select a.g, 1 / (1 + exp(-2 * a.f)) as p0, 1 / (1 + exp(-2 * b.f)) as p1,
                        1 / (1 + exp(-2 * c.f)) as p2
                 from boost0 a join boost1 b using (g, step) join boost2 c using (g, step)
                 where step = 20)""",
        (0, 1, 2),
    ),
}

ORACLES |= {
    "q_mart_incremental": ORACLES["q_mart"],
    "q_mart_bucketed": ORACLES["q_mart"],
    "q_history_bucketed": ORACLES["q_purchase_sequence_ltv"],
    "q_quarantine_counts": _sql(
        """select case when purchaseid % 10 = 0 then 'malformed' when purchaseid % 14 = 1 then 'no username'
                       when purchaseid % 15 = 2 then 'negative price' else 'none' end as reason,
                  count(*) as rows, count(*) as told
           from cohort group by 1""",
        "cohort",
    ),
    "q_quarantine_good": _sql(
        """select purchaseid, username, catalog_price, arpu, arpu_trend, duration, rolling_3_disruptioncount
           from cohort where purchaseid % 10 <> 0 and purchaseid % 14 <> 1 and purchaseid % 15 <> 2""",
        "cohort",
    ),
    "q_external_encode_many": "select c_custkey, "
    + ", ".join(
        f"""cast(if(t{i} is null, null, dense_rank() over (order by t{i} nulls last) - 1) as integer) as t{i}"""
        for i in range(20)
    )
    + " from (select c_custkey, "
    + ", ".join(
        f"if(c_custkey % {i + 3} <> 0, concat_ws('-', c_mktsegment, (c_custkey * {i + 1}) % {7 ** (i % 5)}), null) as t{i}"
        for i in range(20)
    )
    + " from customer)",
    "q_train_faults": _sql(
        """select count(*) as rows, 15 as draws, 0 as better_than_chosen, 0 as averages_off, 0 as supports_off
           from cohort""",
        "cohort",
    ),
}
