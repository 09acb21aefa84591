"""The queries of the catalogue as SQL for DuckDB, written on their own terms."""

from __future__ import annotations

from tallywright.functions.tokens import ENGLISH_STOP_WORDS
from tallywright.plans.tables import CHURN_CUT, MERCHANTS, REGIONS


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _u(key: str, purpose: str = "split") -> str:
    """The keyed hash in [0, 1) for a purpose."""
    return f"(('0x' || substr(md5({key}::varchar || ':42:{purpose}'), 1, 8))::bigint / 4294967296.0::double)"


ORDER_DATES = """
order_dates as (
  select o_orderkey as order_id,
         case when o_orderkey % 20 < 7 then strftime(o_orderdate, '%d-%m-%Y')
              when o_orderkey % 20 < 13 then strftime(o_orderdate, '%-m/%-d/%Y')
              when o_orderkey % 20 < 19 then strftime(o_orderdate, '%m/%d/%Y')
              else strftime(o_orderdate, '%Y-%m-%d') end as order_date
  from orders)
"""

REPAIRED = """coalesce(cast(try_strptime(order_date, '%d-%m-%Y') as date),
                        cast(try_strptime(order_date, '%m/%d/%Y') as date))"""

SALES = (
    ORDER_DATES
    + """,
sales as (
  select o.o_orderkey as order_id, o.o_custkey as customer_id, d.order_date,
         case when o.o_orderkey % 11 <> 0 then n.n_name end as city,
         p.p_type as category, p.p_retailprice as price, l.l_quantity as qty,
         case when o.o_orderkey % 7 <> 0 then l.l_discount * 100 end as discount_pct,
         case when o.o_orderkey % 13 <> 0 then o.o_orderpriority end as payment_method,
         o.o_orderstatus as order_status
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join order_dates d on d.order_id = o.o_orderkey
  left join part p on p.p_partkey = l.l_partkey
  left join customer c on c.c_custkey = o.o_custkey
  left join nation n on n.n_nationkey = c.c_nationkey)
"""
)

CLEAN = (
    SALES
    + f""",
clean as (
  select * exclude (d)
         replace (coalesce(city, 'Unknown') as city, coalesce(discount_pct, 0) as discount_pct,
                    coalesce(payment_method, 'Unknown') as payment_method,
                    coalesce(order_status, 'Unknown') as order_status, d as order_date),
         cast(month(d) as int) as month, cast(day(d) as int) as day, cast(dayofweek(d) + 1 as int) as day_of_week,
         cast(price * qty as decimal(18,2)) as revenue
  from (select *, {REPAIRED} as d from sales)
  where d is not null and price > 0 and qty > 0)
"""
)

TRANSACTIONS = f"""
transactions as (
  select event_id as transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as transaction_time,
         value - 5 as transaction_amount,
         case when event_id % 17 <> 0 then {_list(MERCHANTS)}[event_id * 7919 % 6 + 1] end as merchant,
         cast(18 + user_id % 62 as int) as customer_age,
         {_list(REGIONS)}[user_id % 4 + 1] as customer_region,
         cast(event_type = 'error' as int) as is_fraud
  from events)
"""

SCORED = (
    TRANSACTIONS
    + f""",
scores as (
  select transaction_id, is_fraud,
         0.7::double * {_u('transaction_id', 'score')} + 0.3::double * is_fraud as probability_1
  from transactions),
scored as (select *, case when probability_1 >= 0.5::double then 1.0::double else 0.0::double end as prediction from scores)
"""
)

SWEEP = (
    SCORED
    + """,
counts as (
  select cast(i as int) as step, i * 0.01::double as threshold,
         count(*) filter (where probability_1 >= i * 0.01::double and is_fraud = 1) as tp,
         count(*) filter (where probability_1 >= i * 0.01::double and is_fraud <> 1) as fp,
         count(*) filter (where probability_1 < i * 0.01::double and is_fraud = 1) as fn,
         count(*) filter (where probability_1 < i * 0.01::double and is_fraud <> 1) as tn
  from generate_series(0, 100) as g(i), scored group by i),
per_class as (
  select *, case when tp > 0 then tp / (tp + fp)::double else 0 end as p1,
         case when tp > 0 then tp / (tp + fn)::double else 0 end as r1,
         case when tn > 0 then tn / (tn + fn)::double else 0 end as p0,
         case when tn > 0 then tn / (tn + fp)::double else 0 end as r0
  from counts),
sweep as (
  select step, threshold, tp, fp, fn, tn,
         ((case when p1 + r1 > 0 then 2 * p1 * r1 / (p1 + r1) else 0 end) * (tp + fn)
          + (case when p0 + r0 > 0 then 2 * p0 * r0 / (p0 + r0) else 0 end) * (tn + fp))
         / (tp + fp + fn + tn)::double as f1
  from per_class),
best as (
  select threshold, f1 from (select *, round(f1, 12) as r from sweep) order by r desc, step limit 1)
"""
)

RATED = """
ratings as (
  select o_custkey as user_id, l_partkey as product_id,
         sum(1 + cast(l_quantity as int) % 5)::bigint as points, count(*) as n_lines,
         sum(1 + cast(l_quantity as int) % 5)::double / count(*) as rating
  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2),
rated as (
  select user_id, product_id, rating, prediction
  from ratings join (select product_id, sum(points)::double / sum(n_lines) as prediction
                     from ratings group by 1) using (product_id))
"""

# Decimal rounding of the shortest text of a double is what Spark's round does.
ROUNDED = "cast(round(cast(cast(prediction as varchar) as decimal(24, 18)), 2) as double)"

PATIENTS = """
patients as (
  select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as patient_id,
         l_linenumber * 10 as age, l_quantity as bmi, l_tax * 100 as blood_pressure,
         l_discount * 100 as glucose_level, l_extendedprice as cholesterol,
         cast(l_returnflag = 'R' as int) as disease
  from lineitem)
"""

CUSTOMERS = f"""
customers as (
  select c_custkey as customer_id, n_before as order_count,
         case when c_custkey % 13 = 0 then 'n/a' else cast(cast(c_acctbal as decimal(18,2)) as varchar) end as balance,
         case when n_later > 0 then 'N' else 'Y' end as churn
  from customer left join (
    select o_custkey, count(*) filter (where o_orderdate < date '{CHURN_CUT}') as n_before,
           count(*) filter (where o_orderdate >= date '{CHURN_CUT}') as n_later
    from orders group by 1) on c_custkey = o_custkey)
"""

WORDS = f"""
trimmed as (
  select doc_id as post_id, text, rtrim(lower(text), E' \\t\\n\\x0B\\f\\r') as t from documents),
words as (
  select post_id, case when t = '' and text <> '' then []
                       else regexp_split_to_array(t, '[ \\t\\n\\x0B\\f\\r]') end as words
  from trimmed),
filtered as (
  select post_id, list_filter(words, lambda w: not list_contains({_list(ENGLISH_STOP_WORDS)}, w)) as words from words)
"""

TERMS = (
    WORDS
    + """,
terms as (
  select post_id, term, count(*) as tf
  from (select post_id, unnest(words) as term from filtered) where term <> '' group by 1, 2),
weights as (
  select term, count(*) as doc_freq,
         ln(((select count(*) from documents) + 1)::double / (count(*) + 1)::double) as idf
  from terms group by 1)
"""
)

NULLABLE_LABELS = """
payments as (
  select o_orderkey, case when o_orderkey % 13 <> 0 then o_orderpriority end as payment_method from orders)
"""


def _labels(source: str) -> str:
    return f"""
labels as (
  select payment_method, row_number() over (order by n desc, payment_method) - 1 as i from (
    select payment_method, count(*) as n from {source} where payment_method is not null group by 1))
"""


ORACLES: dict[str, str] = {
    "csv_scan": """
      select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
             strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority from orders""",
    "csv_roundtrip": """
      select c_custkey, '"a, b" ' || c_name as c_name, c_nationkey, c_acctbal,
             case when c_custkey % 11 <> 0 then c_mktsegment end as c_mktsegment from customer""",
    "parquet_roundtrip": "select * replace (cast(l_shipdate as date) as l_shipdate) from lineitem",
    "preview": "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 5",
    "stage_counts": f"""
      with {TRANSACTIONS}
      select 'loaded' as stage, count(*) as n_rows from transactions
      union all select 'complete', count(*) from transactions where merchant is not null
      union all select 'positive', count(*) from transactions where merchant is not null and transaction_amount > 0
      union all select 'fraud', count(*) from transactions
        where merchant is not null and transaction_amount > 0 and is_fraud = 1
      union all select 'genuine', count(*) from transactions
        where merchant is not null and transaction_amount > 0 and is_fraud = 0""",
    "observed_counts": f"""
      with {TRANSACTIONS}
      select 'loaded' as stage, count(*) as n_rows from transactions
      union all select 'complete', count(*) from transactions where merchant is not null
      union all select 'positive', count(*) from transactions where merchant is not null and transaction_amount > 0
      union all select 'fraud', count(*) from transactions
        where merchant is not null and transaction_amount > 0 and is_fraud = 1
      union all select 'genuine', count(*) from transactions
        where merchant is not null and transaction_amount > 0 and is_fraud = 0""",
    "project_columns": "select l_orderkey, l_linenumber, l_quantity from lineitem",
    "drop_rename": f"""
      with {SCORED}
      select transaction_id, is_fraud, probability_1,
             cast(probability_1 >= 0.4::double as int)::double as prediction from scored""",
    "cast_numeric": f"""
      with {CUSTOMERS}
      select customer_id, try_cast(balance as double) as balance, cast(order_count as double) as order_count
      from customers""",
    "revenue": f"with {SALES} select order_id, price, qty, price * qty as revenue from sales",
    "binary_label": f"""
      with {CUSTOMERS} select customer_id, churn, case when churn = 'Y' then 1 else 0 end as churn_label from customers""",
    "optional_column": f"""
      with {TRANSACTIONS}
      select transaction_id, transaction_amount, customer_age, customer_age as age_index,
             0.0::double as merchant_index from transactions""",
    "rounded_prediction": f"with {RATED} select user_id, product_id, {ROUNDED} as rounded from rated",
    "drop_nulls": f"""
      with {SALES} select order_id, qty, city, payment_method, discount_pct from sales
      where city is not null and payment_method is not null and discount_pct is not null""",
    "fill_nulls": f"""
      with {SALES} select order_id, qty, coalesce(city, 'Unknown') as city,
        coalesce(payment_method, 'Unknown') as payment_method, coalesce(discount_pct, 0) as discount_pct from sales""",
    "positive_filter": f"""
      with {TRANSACTIONS} select transaction_id, transaction_amount from transactions where transaction_amount > 0""",
    "conjunctive_filter": """
      select * from (select l_orderkey, l_linenumber, l_quantity - 10 as qty, l_discount - 0.02::double as price
                     from lineitem) where price > 0 and qty > 0""",
    "repeat_customers": f"""
      with {CLEAN} select customer_id, count(distinct order_id) as order_count from clean
      group by 1 having count(distinct order_id) > 1""",
    "class_split": f"""
      with {TRANSACTIONS} select transaction_id, case is_fraud when 1 then 'fraud' else 'genuine' end as side
      from transactions where is_fraud in (0, 1)""",
    "parse_date": f"""
      with {ORDER_DATES}
      select order_id, cast(try_strptime(order_date, '%Y-%m-%d') as date) as order_date from order_dates""",
    "repair_dates": f"""
      with {ORDER_DATES}
      select * from (select order_id, {REPAIRED} as order_date from order_dates) where order_date is not null""",
    "parse_timestamp": f"""
      with {TRANSACTIONS}
      select transaction_id, strptime(transaction_time, '%Y-%m-%d %H:%M:%S') as transaction_time from transactions""",
    "date_parts": f"""
      with {ORDER_DATES}
      select order_id, d as order_date, cast(month(d) as int) as month, cast(day(d) as int) as day,
             cast(dayofweek(d) + 1 as int) as day_of_week
      from (select order_id, {REPAIRED} as d from order_dates) where d is not null""",
    "top_cities": f"""
      with {CLEAN} select city, cast(sum(revenue) as double) as total_revenue from clean
      group by 1 order by sum(revenue) desc, city limit 5""",
    "top_category": f"""
      with {CLEAN} select category, sum(qty) as total_quantity from clean
      group by 1 order by 2 desc, 1 limit 1""",
    "orders_per_customer": f"""
      with {CLEAN} select customer_id, count(distinct order_id) as order_count from clean group by 1""",
    "monthly_revenue": f"""
      with {CLEAN} select cast(year(order_date) as int) as year, cast(month(order_date) as int) as month,
        cast(sum(revenue) as double) as monthly_revenue from clean group by 1, 2 order by 1, 2""",
    "repeat_customer_rate": f"""
      with {CLEAN}, per as (select customer_id, count(distinct order_id) as n from clean group by 1)
      select count(*) filter (where n > 1) as repeat_customers, count(*) as total_customers,
             count(*) filter (where n > 1) / count(*)::double * 100 as repeat_rate from per""",
    "class_counts": f"with {PATIENTS} select disease, count(*) as n_rows from patients group by 1",
    "distinct_guard": f"""
      with {CLEAN}, pairs as (
        select 'city' as column_name, city as v from clean
        union all select 'payment_method', payment_method from clean
        union all select 'order_status', order_status from clean)
      select column_name, count(distinct v) as distinct_values, count(distinct v) >= 2 as enough from pairs group by 1""",
    "sales_clean": f"""
      with {SALES}
      select order_id, coalesce({REPAIRED}, cast(try_strptime(order_date, '%Y-%m-%d') as date)) as order_date,
             payment_method, price, qty
      from sales where payment_method is not null and order_date is not null and qty is not null and price > 0""",
    "sales_prepared": f"with {CLEAN} select * replace (cast(revenue as double) as revenue) from clean",
    "union_all": f"""
      with {TRANSACTIONS}
      select transaction_id, is_fraud from transactions where is_fraud = 0
      union all select transaction_id, is_fraud from transactions where is_fraud = 1
      union all select transaction_id, is_fraud from transactions where is_fraud = 1""",
    "oversample_minority": f"""
      with {TRANSACTIONS},
      m as (select count(*) filter (where is_fraud = 0) / (count(*) filter (where is_fraud = 1))::double as m
            from transactions),
      k as (select transaction_id, is_fraud,
                   case when is_fraud = 0 then 1
                        else floor(m)::int + ({_u('transaction_id', 'copy')} < m - floor(m))::int end as k
            from transactions, m)
      select transaction_id, is_fraud, cast(unnest(generate_series(1, k)) as int) as copy from k""",
    "hash_split": f"""
      select o_orderkey, case when {_u('o_orderkey')} < 0.8::double then 'train' else 'test' end as part from orders""",
    "split_parts": f"""
      select o_orderkey, case when {_u('o_orderkey')} < 0.64::double then 0
                              when {_u('o_orderkey')} < 0.8::double then 1 else 2 end as part from orders""",
    "class_weights": f"""
      with {PATIENTS}, c as (select disease, count(*) as n_rows from patients group by 1)
      select disease, n_rows, (select sum(n_rows) from c)::double / ((select count(*) from c) * n_rows) as weight from c""",
    "train_class_weights": f"""
      with {TRANSACTIONS}, train as (
        select transaction_id, is_fraud from transactions where {_u('transaction_id')} < 0.8::double),
      c as (select count(*) as n, sum(is_fraud)::bigint as n1 from train)
      select transaction_id, is_fraud,
             case when is_fraud = 1 then n::double / (2 * n1) else n::double / (2 * (n - n1)) end as class_weight_col
      from train, c""",
    "string_index": """
      with m as (
        select o_custkey, (row_number() over (order by n desc, o_custkey) - 1)::double as customer_index
        from (select o_custkey, count(*) as n from orders group by 1))
      select o_custkey, o_orderkey, customer_index from orders join m using (o_custkey)""",
    "string_index_keep": f"""
      with {NULLABLE_LABELS}, train as (select * from payments where {_u('o_orderkey')} < 0.8::double),
      {_labels('train')}
      select o_orderkey, p.payment_method, coalesce(i, (select count(*) from labels))::double as payment_index
      from payments p left join labels l on p.payment_method = l.payment_method""",
    "one_hot": f"""
      with {NULLABLE_LABELS}, {_labels('payments')}
      select o_orderkey, (select count(*) from labels)::int as n_slots, coalesce(i, -1) as hot_slot,
             case when i is null then 0.0::double else 1.0::double end as total
      from payments p left join labels l on p.payment_method = l.payment_method""",
    "assemble_features": f"""
      with {PATIENTS} select patient_id, age::double as f0, bmi as f1, blood_pressure as f2, glucose_level as f3,
        cholesterol as f4 from patients""",
    "tokenize": f"""
      with {WORDS} select post_id, len(words)::int as n_words, array_to_string(words, ' ') as words from words""",
    "remove_stopwords": f"""
      with {WORDS} select post_id, len(words)::int as n_words, array_to_string(words, ' ') as words from filtered""",
    "term_frequency": f"with {TERMS} select post_id, term, tf from terms",
    "idf_weights": f"with {TERMS} select term, doc_freq, round(idf, 9) as idf from weights",
    "tf_idf": f"""
      with {TERMS} select post_id, term, tf, doc_freq, round(idf, 9) as idf, round(tf * idf, 9) as tf_idf
      from terms join weights using (term)""",
    "index_to_string": """
      select o_orderkey, (o_orderkey % 5)::double as prediction,
             case o_orderkey % 5 when 0 then 'positive' when 1 then 'negative' when 2 then 'neutral'
                  else '__unknown' end as predicted_label from orders""",
    "confusion_matrix": f"""
      with {SCORED} select is_fraud, prediction, count(*) as n_rows from scored group by 1, 2""",
    "rating_comparison": f"""
      with {RATED} select rating as "Actual_Rating", {ROUNDED} as "Predicted_Rating", count(*) as "Count"
      from rated group by 1, 2""",
    "positive_recall": f"""
      with {SCORED}, c as (
        select count(*) filter (where is_fraud = 1 and prediction = 1) as tp,
               count(*) filter (where is_fraud = 1 and prediction = 0) as fn from scored)
      select tp, fn, tp::double / greatest(tp + fn, 1) as recall from c""",
    "classification_report": f"""
      with {SCORED}, c as (
        select x.class, count(*) filter (where is_fraud = x.class and prediction = x.class) as tp,
               count(*) filter (where is_fraud = x.class) as support,
               count(*) filter (where prediction = x.class) as predicted
        from scored, (values (0), (1)) as x(class) group by 1),
      pr as (select *, tp::double / greatest(predicted, 1) as p, tp::double / greatest(support, 1) as r from c)
      select round(sum(tp)::double / sum(support), 9) as accuracy,
             round(sum(p * support) / sum(support), 9) as weighted_precision,
             round(sum(r * support) / sum(support), 9) as weighted_recall,
             round(sum((case when p + r > 0 then 2 * p * r / (p + r) else 0 end) * support) / sum(support), 9) as f1
      from pr""",
    "per_class_metrics": f"""
      with {SCORED}, c as (
        select x.class::double as class, count(*) filter (where is_fraud = x.class and prediction = x.class) as tp,
               count(*) filter (where is_fraud = x.class) as support,
               count(*) filter (where prediction = x.class) as predicted
        from scored, (values (0), (1)) as x(class) group by 1),
      pr as (select *, tp::double / greatest(predicted, 1) as p, tp::double / greatest(support, 1) as r from c)
      select class, tp, support, predicted, round(p, 9) as precision, round(r, 9) as recall,
             round(case when p + r > 0 then 2 * p * r / (p + r) else 0 end, 9) as f1 from pr""",
    "threshold_sweep": f"""
      with {SWEEP} select step, threshold, tp, fp, fn, tn, round(f1, 9) as f1 from sweep""",
    "best_threshold": f"with {SWEEP} select threshold, round(f1, 9) as f1 from best",
    "apply_threshold": f"""
      with {SWEEP} select transaction_id,
        cast(probability_1 >= (select threshold from best) as int)::double as prediction_best from scored""",
    "regression_metrics": f"""
      with {RATED} select round(sqrt(avg((rating - prediction) * (rating - prediction))), 9) as rmse,
        round(avg(abs(rating - prediction)), 9) as mae, count(*) as n_rows from rated""",
    "logit_score": f"""
      with {TRANSACTIONS}, s as (
        select transaction_id, 1.0::double / (1.0::double + exp(-(-0.5::double
          + transaction_amount * 0.02::double + customer_age * (-0.01::double)))) as p from transactions)
      select transaction_id, round(p, 9) as probability_1, cast(p > 0.4::double as int)::double as prediction from s""",
    "csv_roundtrip_text": "select * from documents",
    "single_file": "select 1::bigint as n_files, count(distinct o_orderpriority) as n_rows from orders",
    "kept_rows": """
      select o_orderstatus, count(*) as n_rows, (select count(*) from orders) as n_all from orders group by 1""",
    "probability_of_class": f"with {SCORED} select transaction_id, probability_1 as p from scored",
    "fraud_rows_needed": f"""
      with {TRANSACTIONS} select transaction_id, coalesce(merchant, 'unknown') as merchant
      from transactions where transaction_amount > 0""",
    "fraud_rows_all": f"""
      with {TRANSACTIONS} select transaction_id, merchant
      from transactions where transaction_amount > 0 and merchant is not null""",
    "train_oversample": f"""
      with {TRANSACTIONS},
      train as (select * from transactions where {_u('transaction_id')} < 0.8::double),
      m as (select count(*) filter (where is_fraud = 0) / (count(*) filter (where is_fraud = 1))::double as m from train),
      k as (select transaction_id, is_fraud,
                   case when is_fraud = 0 then 1
                        else floor(m)::int + ({_u('transaction_id', 'copy')} < m - floor(m))::int end as k
            from train, m)
      select transaction_id, is_fraud, cast(unnest(generate_series(1, k)) as int) as copy from k""",
    "fold_sizes": f"""
      with {PATIENTS},
      train as (select {_u('patient_id', 'fold')} as u from patients where {_u('patient_id')} < 0.8::double)
      select case when u < 1::double / 3 then 0 when u < 2::double / 3 then 1 else 2 end as fold, count(*) as n_rows
      from train group by 1""",
    "assemble_keep": """
      select l_orderkey, l_linenumber, l_quantity as f0, l_orderkey % 7 = 0 as missing from lineitem""",
    **{
        name: f"""
      with {TRANSACTIONS} select transaction_id, is_fraud, true as {check}, true as by_threshold
      from transactions where transaction_amount > 0 and {_u('transaction_id')} >= 0.8::double"""
        for name, check in (
            ("fraud_lr_rows", "from_coefficients"),
            ("fraud_lr_threshold_rows", "from_coefficients"),
            ("fraud_rf_rows", "from_trees"),
        )
    },
    "fraud_rf_deep_rows": f"""
      with {TRANSACTIONS},
      held as (select is_fraud from transactions where transaction_amount > 0
               and {_u('transaction_id')} >= 0.64::double and {_u('transaction_id')} < 0.8::double)
      select cast(i as int) as step, count(*) filter (where is_fraud = 1) as positives,
             count(*) filter (where is_fraud = 0) as negatives, true as from_trees, true as by_threshold
      from generate_series(0, 100) as g(i), held group by i""",
    "churn_lr_rows": f"""
      with {CUSTOMERS} select customer_id, case when churn = 'Y' then 1 else 0 end as churn_label,
        true as from_coefficients, true as by_threshold
      from customers where balance <> 'n/a' and order_count > 0""",
    "price_rf_rows": f"""
      with {CLEAN} select order_id, qty, price, true as from_trees from clean where {_u('order_id')} >= 0.8::double""",
    "als_predict_rows": f"""
      with {RATED},
      parted as (select *, {_u("user_id || ':' || product_id")} as u from ratings),
      train as (select * from parted where u < 0.8::double)
      select user_id, product_id, round(rating, 9) as rating, true as from_factors, true as rounded_well
      from parted where u >= 0.8::double and user_id in (select user_id from train)
        and product_id in (select product_id from train)""",
    "top3_rows": """
      select user_id, unnest([1, 2, 3]) as place, true as from_factors, true as falls, true as different
      from (select distinct o_custkey as user_id from orders join lineitem on l_orderkey = o_orderkey)""",
    "disease_rows": f"""
      with {PATIENTS} select patient_id, disease, true as from_trees, true as by_threshold
      from patients where {_u('patient_id')} >= 0.8::double""",
    "path_scan": "select o_orderkey, o_custkey, o_orderstatus from orders",
    "replaced_rows": "select o_orderkey, o_totalprice, true as kept from orders where o_orderkey % 3 = 0",
    "empty_input": """
      select * from (values ('all', false, false, false), ('none', true, true, true), ('one city', true, true, true))
        as t("case", no_model, no_rows, no_errors)""",
    "disease_grid_rows": """
      select trees::bigint as "numTrees", depth::bigint as "maxDepth", true as from_folds
      from (values (50), (100)) as t(trees), (values (5), (10)) as d(depth)""",
    "sentiment_lr_rows": f"""
      select post_id, sentiment, true as from_coefficients, true as likeliest, true as known_label from (
        select doc_id as post_id, case when toxic = 1 then 'negative' when quality = 1 then 'positive'
                                       else 'neutral' end as sentiment
        from documents join labels using (doc_id))
      where {_u('post_id')} >= 0.8::double""",
    "sentiment_grid_rows": """
      select n::bigint as "numFeatures", r::double as "regParam", true as from_folds
      from (values (1000), (2000)) as t(n), (values (0.01), (0.1)) as d(r)""",
    "hashing_tf_totals": f"""
      with {WORDS} select post_id, len(words) as n_words from filtered where len(words) > 0""",
}
