"""The composite jobs again, as SQL for the checking engine."""

from __future__ import annotations

from checks.views import FIXTURE

STAMP = "%Y-%m-%d %H:%M:%S"
FIRST_YEAR, LAST_YEAR = 1995, 2001


def stamp(column: str) -> str:
    return f"try_strptime({column}, '{STAMP}')"


def clipped(column: str) -> str:
    return (
        f"case when year({stamp(column)}) between {FIRST_YEAR} and {LAST_YEAR} "
        f"then {stamp(column)} end"
    )


def days(later: str, earlier: str) -> str:
    return f"cast(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) as bigint)"


def place(df: str, zip_column: str, city: str, state: str, rest: str) -> str:
    return f"""
select {rest},
 case when length(trim(cast({zip_column} as varchar))) >= 5 then trim(cast({zip_column} as varchar))
   else lpad(trim(cast({zip_column} as varchar)), 5, '0') end as {zip_column},
 strip_accents(trim(lower({city}))) as {city}, trim(upper({state})) as {state} from {df}"""


def haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return (
        f"2 * 6371.0088 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin((radians({lng2}) - radians({lng1})) / 2), 2)))"
    )


TWINS = {
    "tw_orders_paid": f"""
select order_id, customer_id, order_status,
 {clipped('order_purchase_timestamp')} as order_purchase_timestamp,
 {clipped('order_approved_at')} as order_approved_at,
 {clipped('order_delivered_customer_date')} as order_delivered_customer_date,
 {clipped('order_estimated_delivery_date')} as order_estimated_delivery_date
 from fx_orders
 where order_status is null
   or order_status not in ('canceled', 'created', 'invoiced', 'unavailable')""",
    "tw_clean_orders": """
select order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
 coalesce(order_delivered_customer_date,
   make_timestamp(epoch_us(order_estimated_delivery_date) - (
     select cast(trunc(quantile_cont(
       epoch_us(order_estimated_delivery_date) - epoch_us(order_delivered_customer_date), 0.5))
       as bigint) from tw_orders_paid))) as order_delivered_customer_date,
 order_estimated_delivery_date
 from tw_orders_paid where order_approved_at is not null""",
    "tw_item_caps": """
select quantile_cont(price, 0.999) as price_cap, quantile_cont(freight_value, 0.999) as freight_cap
 from fx_items""",
    "tw_clean_items": """
select order_id, order_item_id, product_id, seller_id,
 case when price > price_cap then price_cap else price end as price,
 case when freight_value > freight_cap then freight_cap else freight_value end as freight_value
 from fx_items, tw_item_caps""",
    "tw_known_payments": """
select * from fx_payments where payment_type is null or payment_type <> 'not_defined'""",
    "tw_clean_payments": """
select order_id, payment_type, payment_value,
 case when payment_installments > cap then cap else payment_installments end
   as payment_installments
 from tw_known_payments,
  (select quantile_cont(payment_installments, 0.99) as cap from tw_known_payments)""",
    "tw_clean_customers": place(
        "fx_customers", "customer_zip_code_prefix", "customer_city", "customer_state",
        "customer_id, customer_unique_id",
    ),
    "tw_clean_sellers": place(
        "fx_sellers", "seller_zip_code_prefix", "seller_city", "seller_state", "seller_id"
    ),
    "tw_points": "select distinct * from (" + place(
        "fx_geolocation", "geolocation_zip_code_prefix", "geolocation_city",
        "geolocation_state", "geolocation_lat, geolocation_lng",
    ) + ")",
    "tw_points_inside": """
select * from tw_points where geolocation_lat between -33.75116944 and 5.27438888
 and geolocation_lng between -73.98283055 and -34.79314722""",
    "tw_noisy_zips": """
select geolocation_zip_code_prefix from tw_points_inside group by 1
 having max(geolocation_lat) - min(geolocation_lat) > 0.5
  or max(geolocation_lng) - min(geolocation_lng) > 0.5""",
    "tw_clean_geolocation": """
select geolocation_zip_code_prefix, avg(geolocation_lat) as geolocation_lat,
 avg(geolocation_lng) as geolocation_lng from tw_points_inside
 where geolocation_zip_code_prefix not in (select geolocation_zip_code_prefix from tw_noisy_zips)
 group by 1""",
    "tw_clean_products": """
select product_id, coalesce(product_category_name, 'unknown') as product_category_name,
 cast(coalesce(product_name_lenght, 0) as integer) as product_name_length,
 cast(coalesce(product_description_lenght, 0) as integer) as product_description_length,
 cast(coalesce(product_photos_qty, 0) as integer) as product_photos_qty,
 product_weight_g, product_length_cm, product_height_cm, product_width_cm
 from fx_products where product_weight_g is not null and product_length_cm is not null
 and product_height_cm is not null and product_width_cm is not null""",
    "tw_first_items": """
select order_id, product_id, seller_id from (
 select *, row_number() over (partition by order_id order by order_item_id, product_id, seller_id)
   as rn from fx_items) where rn = 1""",
    "tw_persons": """
select o.order_id, o.customer_id, c.customer_unique_id
 from tw_clean_orders o left join fx_customers c using (customer_id)""",
    "tw_labels": """
select p.order_id, p.customer_id, p.customer_unique_id, f.product_id, f.seller_id,
 r.num_orders, r.num_orders > 1 as is_repeat_buyer
 from tw_persons p
 join (select customer_unique_id, count(distinct order_id) as num_orders from tw_persons
   where customer_unique_id is not null group by 1) r using (customer_unique_id)
 join tw_first_items f using (order_id)""",
    "tw_order_payments": """
select order_id,
 coalesce(sum(case when payment_type = 'credit_card' then payment_value end), 0) as credit_card,
 coalesce(sum(case when payment_type = 'voucher' then payment_value end), 0) as voucher,
 coalesce(sum(case when payment_type = 'debit_card' then payment_value end), 0) as debit_card,
 coalesce(sum(case when payment_type = 'boleto' then payment_value end), 0) as boleto,
 coalesce(sum(payment_value), 0) as total_spent,
 cast(coalesce(sum(payment_installments), 0) as bigint) as installment
 from tw_clean_payments group by order_id""",
    "tw_transactions": f"""
select i.order_id, i.product_id, i.seller_id, l.customer_id, l.customer_unique_id,
 {days('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} as deli_duration_exp,
 {days('o.order_delivered_customer_date', 'o.order_approved_at')} as deli_duration_paid,
 i.freight_value as deli_cost, i.freight_value = 0.0 as free_delivery, i.price as item_price,
 i.price > (select quantile_cont(price, 0.75)
   + 1.5 * (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)) from tw_clean_items)
   as high_price,
 cast(i.price as decimal(18,6)) * a.n < a.s as discount,
 b.n > 1 as is_bulk, l.is_repeat_buyer, p.installment,
 case when p.total_spent = 0 then 0 else p.credit_card / p.total_spent end as credit_card,
 case when p.total_spent = 0 then 0 else p.voucher / p.total_spent end as voucher,
 case when p.total_spent = 0 then 0 else p.debit_card / p.total_spent end as debit_card,
 case when p.total_spent = 0 then 0 else p.boleto / p.total_spent end as boleto,
 p.total_spent
 from tw_clean_items i
 join tw_clean_orders o using (order_id)
 join tw_labels l using (order_id)
 join tw_order_payments p using (order_id)
 join (select product_id, sum(cast(price as decimal(18,6))) as s, count(price) as n
   from tw_clean_items group by 1) a on a.product_id = i.product_id
 join (select order_id, product_id, count(*) as n from tw_clean_items group by 1, 2) b
   on b.order_id = i.order_id and b.product_id = i.product_id
 where o.order_delivered_customer_date is not null
   and o.order_estimated_delivery_date is not null""",
    "tw_product_features": """
select p.product_id, t.product_category_name_english as product_category_name,
 product_name_length, product_description_length, product_photos_qty, product_weight_g,
 product_length_cm, product_height_cm, product_width_cm
 from tw_clean_products p
 left join fx_translation t on t.product_category_name = p.product_category_name""",
    "tw_dense_cities": """
select customer_city from tw_clean_customers where customer_city is not null
 group by 1 order by count(*) desc, customer_city limit 5""",
    "tw_tagged_customers": """
select customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
 case when customer_city in (select customer_city from tw_dense_cities) then 1 else 0 end
   as high_density_customer_area from tw_clean_customers""",
    "tw_located_items": """
select i.order_id, i.order_item_id, i.product_id, i.seller_id, c.high_density_customer_area,
 cg.geolocation_lat as customer_lat, cg.geolocation_lng as customer_lng,
 sg.geolocation_lat as seller_lat, sg.geolocation_lng as seller_lng
 from fx_items i join tw_clean_orders o using (order_id)
 join tw_tagged_customers c using (customer_id)
 join tw_clean_geolocation cg on cg.geolocation_zip_code_prefix = c.customer_zip_code_prefix
 join tw_clean_sellers s on s.seller_id = i.seller_id
 join tw_clean_geolocation sg on sg.geolocation_zip_code_prefix = s.seller_zip_code_prefix""",
    "tw_distances": f"""
select l.*, d.distance_km, d.high_density_customer_area from tw_labels l join (
 select order_id, high_density_customer_area,
  {haversine('customer_lat', 'customer_lng', 'seller_lat', 'seller_lng')} as distance_km
 from (select *, row_number() over (partition by order_id
   order by order_item_id, product_id, seller_id) as rn from tw_located_items)
 where rn = 1) d using (order_id)""",
    "tw_seller_stats": """
select d.*, r.rate as seller_repeat_buyer_rate from tw_distances d join (
 select seller_id, count(distinct case when is_repeat_buyer then customer_unique_id end) * 1.0e0
  / count(distinct customer_unique_id) as rate from tw_distances group by 1) r using (seller_id)""",
    "tw_model_inputs": """
select distinct t.deli_duration_exp, t.deli_duration_paid, t.deli_cost, t.free_delivery, t.is_bulk,
 t.discount, t.item_price, t.high_price, t.credit_card, t.voucher, t.debit_card, t.boleto,
 t.total_spent, t.installment, s.distance_km, s.high_density_customer_area,
 s.seller_repeat_buyer_rate, r.review_score, p.product_category_name, p.product_name_length,
 p.product_description_length, p.product_photos_qty, p.product_weight_g, p.product_length_cm,
 p.product_height_cm, p.product_width_cm, t.is_repeat_buyer
 from tw_transactions t
 left join tw_seller_stats s on s.order_id = t.order_id and s.product_id = t.product_id
  and s.seller_id = t.seller_id and s.customer_id = t.customer_id
  and s.customer_unique_id = t.customer_unique_id
 left join tw_product_features p on p.product_id = t.product_id
 left join fx_reviews r on r.order_id = t.order_id
 where s.distance_km is not null and r.review_score is not null
  and p.product_category_name is not null""",
    "tw_weak": """
select *, coalesce(review_score > 3, false) or coalesce(deli_duration_exp <= -7, false)
 or coalesce(voucher >= 0.3, false)
 or coalesce(total_spent >= (select quantile_cont(total_spent, 0.8) from tw_model_inputs), false)
 or coalesce(product_category_name in (select product_category_name from tw_model_inputs
   where product_category_name is not null group by 1
   order by count(*) desc, product_category_name limit 10), false) as weak_positive
 from tw_model_inputs""",
    "tw_thresholds": """
select threshold, sum(pos) over w as tp, sum(neg) over w as fp, pos, neg,
 sum(pos) over () as p, sum(neg) over () as n from (
  select score as threshold, count(*) filter (label = 1) as pos,
   count(*) filter (label = 0) as neg from fx_scores group by 1)
 window w as (order by threshold desc)""",
    "tw_rates": """
select *, tp * 1.0e0 / (tp + fp) as precision_, tp * 1.0e0 / p as recall_, fp * 1.0e0 / n as fpr_,
 coalesce(lag(tp * 1.0e0 / (tp + fp)) over w, 1.0e0) as precision_before,
 coalesce(lag(tp * 1.0e0 / p) over w, 0.0e0) as recall_before,
 coalesce(lag(fp * 1.0e0 / n) over w, 0.0e0) as fpr_before
 from tw_thresholds window w as (order by threshold desc)""",
    "tw_report": """
select accuracy, unnest([
 {'class': '0', 'precision': p0, 'recall': r0, 'f1_score': f0, 'support': s0},
 {'class': '1', 'precision': p1, 'recall': r1, 'f1_score': f1, 'support': s1},
 {'class': 'macro avg', 'precision': (p0 + p1) / 2, 'recall': (r0 + r1) / 2,
  'f1_score': (f0 + f1) / 2, 'support': s0 + s1},
 {'class': 'weighted avg', 'precision': (p0 * s0 + p1 * s1) / (s0 + s1),
  'recall': (r0 * s0 + r1 * s1) / (s0 + s1),
  'f1_score': (f0 * s0 + f1 * s1) / (s0 + s1), 'support': s0 + s1}], recursive := true)
 from (select tn * 1.0e0 / (tn + fn) as p0, tn * 1.0e0 / (tn + fp) as r0,
   2.0e0 * tn / (2 * tn + fn + fp) as f0, tn + fp as s0,
   tp * 1.0e0 / (tp + fp) as p1, tp * 1.0e0 / (tp + fn) as r1,
   2.0e0 * tp / (2 * tp + fp + fn) as f1, tp + fn as s1,
   (tp + tn) * 1.0e0 / (tp + tn + fp + fn) as accuracy
  from (select count(*) filter (label = 1 and prediction = 1) as tp,
    count(*) filter (label = 0 and prediction = 1) as fp,
    count(*) filter (label = 1 and prediction = 0) as fn,
    count(*) filter (label = 0 and prediction = 0) as tn from fx_scores))""",
}

ALL_VIEWS = {**FIXTURE, **TWINS}
