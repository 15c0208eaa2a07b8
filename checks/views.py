"""Marketplace-shaped views over the whole test tables.

Each view is one SQL text that both Spark and the checking engine run. No view leaves rows
out: odd values (bad dates, unpaid orders, missing fields, a zip without usable coordinates)
are written into the columns.
"""

from __future__ import annotations

import re

FIXTURE = {
    "fx_orders": """
select o_orderkey as order_id, o_orderkey as customer_id,
 case o_orderkey % 20 when 0 then 'canceled' when 1 then 'unavailable'
   when 2 then cast(null as varchar(20)) else 'delivered' end as order_status,
 cast(o_orderdate as varchar(40)) as order_purchase_timestamp,
 case when o_orderkey % 50 = 3 then cast(null as varchar(40))
   when o_orderkey % 101 = 0 then '1985-05-05 00:00:00'
   when o_orderkey % 103 = 0 then 'bad'
   else cast(o_orderdate + interval '1' hour * (o_orderkey % 48) as varchar(40)) end
   as order_approved_at,
 cast(o_orderdate + interval '2' day as varchar(40)) as order_delivered_carrier_date,
 case when o_orderkey % 33 = 5 then cast(null as varchar(40))
   else cast(o_orderdate + interval '1' hour * (72 + (o_orderkey * 37) % 720) as varchar(40)) end
   as order_delivered_customer_date,
 cast(o_orderdate + interval '1' day * (10 + o_orderkey % 15) as varchar(40))
   as order_estimated_delivery_date
 from orders""",
    "fx_items": """
select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
 l_suppkey as seller_id, l_shipdate as shipping_limit_date, l_extendedprice as price,
 l_extendedprice * l_tax as freight_value
 from lineitem""",
    "fx_payments": """
select l_orderkey as order_id, l_linenumber as payment_sequential,
 case l_linenumber % 5 when 1 then 'credit_card' when 2 then 'boleto' when 3 then 'voucher'
   when 4 then 'debit_card' else 'not_defined' end as payment_type,
 cast(l_quantity as int) as payment_installments, l_extendedprice as payment_value
 from lineitem""",
    "fx_customers": """
select o_orderkey as customer_id,
 case when o_orderpriority = '1-URGENT' then o_custkey else -o_orderkey - 1 end
   as customer_unique_id,
 cast(c_nationkey * 97 + 13 as varchar(10)) as customer_zip_code_prefix,
 case when c_nationkey % 3 = 0 then concat(' São ', n_name, ' ') else n_name end as customer_city,
 concat(lower(r_name), ' ') as customer_state
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
 join region on n_regionkey = r_regionkey""",
    "fx_sellers": """
select s_suppkey as seller_id, cast(s_nationkey * 97 + 13 as varchar(10)) as seller_zip_code_prefix,
 case when s_nationkey % 3 = 0 then concat(' São ', n_name, ' ') else n_name end as seller_city,
 lower(r_name) as seller_state
 from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "fx_geolocation": """
select cast(c_nationkey * 97 + 13 as varchar(10)) as geolocation_zip_code_prefix,
 case when c_custkey % 50 = 0 or c_nationkey = 11 then cast(60 as double)
   else -30 + c_nationkey * 1.2e0
     + (c_custkey % 10) * (case when c_nationkey = 7 then 0.1e0 else 0.01e0 end) end
   as geolocation_lat,
 -70 + c_nationkey * 1.3e0 as geolocation_lng, n_name as geolocation_city,
 lower(r_name) as geolocation_state
 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "fx_reviews": """
select o_orderkey as review_id, o_orderkey as order_id,
 cast(1 + o_orderkey % 5 as int) as review_score,
 coalesce(d.text, case o_orderkey % 6 when 0 then 'Tudo certo'
   when 1 then 'Produto excelente, recomendo' when 2 then ' ' when 3 then cast(null as varchar(40))
   when 4 then 'chegou com atraso' else 'conforme' end) as review_comment_message
 from orders left join documents d on d.doc_id = o_orderkey
 union all select -o_orderkey - 1, o_orderkey, 5, 'segunda vez' from orders
 where o_orderpriority = '1-URGENT'""",
    "fx_products": """
select p_partkey as product_id,
 case when p_partkey % 17 = 0 then cast(null as varchar(20))
   else concat(p_type, '_', cast(p_size % 4 as varchar(2))) end as product_category_name,
 case when p_partkey % 19 = 0 then cast(null as double) else cast(length(p_name) as double) end
   as product_name_lenght,
 cast(length(p_brand) * 10 as double) as product_description_lenght,
 cast(p_size % 5 as double) as product_photos_qty,
 case when p_partkey % 23 = 0 then cast(null as double) else cast(p_size * 100 as double) end
   as product_weight_g,
 cast(p_size as double) as product_length_cm, cast(p_size % 20 + 1 as double) as product_height_cm,
 cast(p_size % 30 + 1 as double) as product_width_cm from part""",
    "fx_translation": "select * from (values " + ", ".join(
        f"('{kind}_{k}', '{kind.lower()}_{k}_en')"
        for kind in ["MEDIUM", "STANDARD", "LARGE", "PROMO", "SMALL"] for k in range(4)
    ) + ") t(product_category_name, product_category_name_english)",
    # Labelled scores for the metric operators: many distinct ones, some ties, both classes.
    "fx_scores": """
select event_id as row_id,
 case when event_type = 'purchase' or (event_type = 'click' and value > 100) then 1 else 0 end
   as label,
 case when event_id % 10 = 0 then floor(value) else value end / 1000.0e0 as score,
 case when value >= 120 then 1 else 0 end as prediction
 from events""",
}

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "labels",
]


def with_views(body: str, views: dict[str, str]) -> str:
    """Prefix a query with the views it needs, directly or through other views."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(views[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{name} as ({views[name].strip()})" for name in needed)
    return f"with {parts}\n{body.strip()}"
