"""The given tables seen as the tables of the library, whole, by arithmetic on their columns.

``VIEW_SQL`` holds the same views for the SQL side; the two must be changed together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "2024-01-15"
YEAR = 1998
AS_OF = "2025-12-31"
TARGET = "2002-12-31"
DOMAIN = "corp.example"
RESTRICTED = ["PROMO", "SMALL"]
RULES = [
    ("ring", "Jewellery"),
    ("widget", "Gadgets"),
    ("gizmo", "Gadgets"),
    ("bolt", "Hardware"),
    ("red", "Red things"),
    ("gear", "Hardware"),
]


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def customers(self) -> DataFrame:
        k = "c_custkey"
        return self.table("customer").join(self.table("nation"), F.expr("c_nationkey = n_nationkey")).selectExpr(
            f"cast({k} as string) as customer_id",
            f"get(array('Ana','Ion','Maria','Radu','Elena'), cast({k} % 5 as int)) as first_name",
            f"case when {k} % 33 = 4 then null else "
            f"get(array('Popa','Ionescu','Marin','Dumitru','Stan','Rusu','Moldovan'), cast({k} % 7 as int)) end"
            " as last_name",
            f"case when {k} % 50 <> 3 then date_add(date'1935-01-01', cast({k} * 7919 % 29000 as int)) end"
            " as birth_date",
            f"case when {k} % 14 = 3 then null when {k} % 97 = 5 then '312.5' else concat('user', {k}, '@', "
            f"get(array('Mail.example','post.example','corp.example','web.example'), cast({k} % 4 as int))) end"
            " as email",
            f"case when {k} % 10 = 9 then null when {k} % 61 = 2 then '312.5' else concat("
            f"get(array('+40','0040 ','0','40'), cast({k} % 4 as int)), "
            f"get(array('744','722','772','735','799'), cast({k} % 5 as int)), ' ', "
            f"lpad(cast({k} * 131 % 1000 as string), 3, '0'), '-', lpad(cast({k} * 17 % 1000 as string), 3, '0')) end"
            " as phone_number",
            f"case when {k} % 20 = 7 then null when {k} % 71 = 2 then '312.5' else concat("
            f"get(array('Str. ','Strada ','Bd. ','Bulevardul ','Calea ','Aleea '), cast({k} % 6 as int)), "
            f"get(array('Mihai Viteazu','Unirii','Florilor','Libertății','Gării'), cast({k} % 5 as int)), "
            f"case when {k} % 3 = 0 then ', nr. ' when {k} % 3 = 1 then ' Nr ' else ' ' end, {k} % 250 + 1, "
            f"case when {k} % 4 = 1 then concat(', ap. ', {k} % 80 + 1) else '' end, ', ', n_name) end as address",
            f"case when {k} % 41 <> 6 then n_name end as city",
            f"case when {k} % 4 = 0 then null when {k} % 89 = 1 then '312.5' else concat("
            f"'{{\"card_id\": \"K', {k}, '\", \"issue_date\": \"', 2010 + {k} % 15, '-0', {k} % 9 + 1, '-1', {k} % 10, "
            f"'\", \"type\": \"', get(array('silver','gold','platinum'), cast({k} % 3 as int)), '\"}}') end"
            " as fidelity_card",
            f"case when {k} % 12 = 0 then 'persoana_juridica' else 'persoana_fizica' end as customer_type",
        )

    @property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "p_name as product_name",
            "case when p_partkey % 10 = 0 then 'ALTELE' else p_type end as category",
            "case when p_size <= 25 then 0.09D else 0.19D end as tva_rate",
            "p_retailprice as base_price",
            "case when p_type in ('PROMO', 'SMALL') then 'true' else 'false' end as age_restricted",
        )

    @property
    def prices(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) as price_id",
            "cast(l_partkey as string) as product_id",
            "cast(l_shipdate as date) as valid_date",
            "floor(l_extendedprice / l_quantity * 100 + 0.5D) / 100D as price",
        )

    @property
    def discounts(self) -> DataFrame:
        week = "next_day(date_sub(cast(l_shipdate as date), 7), 'Wed')"
        return self.table("lineitem").selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey) as discount_id",
            "cast(l_partkey as string) as product_id",
            "l_discount as discount_percentage",
            f"{week} as valid_from",
            f"date_add({week}, 6) as valid_to",
        )

    @property
    def transactions(self) -> DataFrame:
        lines = self.table("lineitem").join(self.table("orders"), F.expr("l_orderkey = o_orderkey"))
        return lines.selectExpr(
            "cast(o_orderkey as string) as transaction_id",
            "cast(o_custkey as string) as customer_id",
            "cast(l_partkey as string) as product_id",
            "cast(l_quantity as int) as quantity",
            "o_orderdate + make_dt_interval(0, cast(7 + o_orderkey % 15 as int), cast(o_orderkey % 60 as int))"
            " as transaction_date",
            "o_orderpriority as payment_method",
            "concat('S', o_orderkey % 5) as store_id",
            "floor(l_extendedprice / l_quantity * 100 + 0.5D) / 100D as unit_price_at_purchase",
        )

    @property
    def sales(self) -> DataFrame:
        return self.table("events").selectExpr(
            "cast(event_id as string) as transaction_id",
            "cast(user_id as int) as client_id",
            "ts as transaction_date",
            "value as amount",
            "concat('M', substring(get_json_object(props, '$.k'), 1, 1)) as merchant",
            "case event_type when 'view' then 'groceries' when 'click' then 'Food' when 'signup' then 'transport'"
            " when 'purchase' then 'shopping' end as category",
        )

    @property
    def accounts(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "concat('A', c_custkey) as account_id",
            "cast(c_custkey as int) as client_id",
            "c_mktsegment as account_type",
            "c_acctbal as opening_balance",
            f"timestamp_ntz'{DAY} 10:00:00' as open_date",
        )

    @property
    def loans(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as loan_id",
            "cast(o_custkey as int) as client_id",
            "o_totalprice / 10 as principal_amount",
            "1.5D + (o_orderkey % 106) / 10D as interest_rate",
            f"timestamp_ntz'{DAY} 09:00:00' as start_date",
            "cast(12 * (1 + o_orderkey % 5) as int) as term_months",
            "o_orderpriority as loan_type",
        )

    @property
    def delay_fees(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) as fee_id",
            "cast(l_suppkey as int) as client_id",
            "cast(l_orderkey as string) as loan_id",
            "l_quantity * 10 as fee_amount",
            f"timestamp_ntz'{DAY} 12:00:00' as fee_date",
            "l_linenumber * 13 as days_delayed",
        )

    @property
    def users(self) -> DataFrame:
        return self.table("customer").join(self.table("nation"), F.expr("c_nationkey = n_nationkey")).selectExpr(
            "c_custkey as user_id", "n_name as country", "date'2024-01-01' as signup_date"
        )

    @property
    def user_events(self) -> DataFrame:
        return self.table("events").selectExpr("event_id", "user_id", "ts as event_time", "event_type")

    @property
    def visits(self) -> DataFrame:
        return self.table("events").selectExpr("user_id", "event_type as page", "ts")

    @property
    def user_sales(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_suppkey as user_id", "l_returnflag as item", "l_extendedprice as price",
            "cast(l_quantity as int) as quantity",
        )

    @property
    def latency_events(self) -> DataFrame:
        lines = self.table("lineitem").join(self.table("orders"), F.expr("l_orderkey = o_orderkey"))
        return lines.selectExpr(
            "o_orderpriority as dataset",
            "l_returnflag as dataproduct",
            "l_linestatus as mandant",
            "date_format(o_orderdate, 'yyyy-MM-dd') as refdate",
            "date_format(l_shipdate + make_dt_interval(0, cast(l_linenumber as int)), 'yyyy-MM-dd HH:mm:ss') as timestamp",
        )


def _pick(values: str, index: str) -> str:
    return f"list_extract([{values}], cast({index} as int) + 1)"


_WEDNESDAY = "cast({0} - cast((dayofweek({0}) + 4) % 7 as int) as date)"


def wednesday(day: str) -> str:
    """The Wednesday on or before a date, in SQL (Sunday is day 0 there)."""
    return _WEDNESDAY.format(day)


_SHIPPED = "cast(l_shipdate as date)"
_K = "c_custkey"

VIEW_SQL = {
    "customers": f"""
        select cast({_K} as varchar) as customer_id,
          {_pick("'Ana','Ion','Maria','Radu','Elena'", f"{_K} % 5")} as first_name,
          case when {_K} % 33 = 4 then null else
            {_pick("'Popa','Ionescu','Marin','Dumitru','Stan','Rusu','Moldovan'", f"{_K} % 7")} end as last_name,
          case when {_K} % 50 <> 3 then cast(date '1935-01-01' + cast({_K} * 7919 % 29000 as int) as date) end as birth_date,
          case when {_K} % 14 = 3 then null when {_K} % 97 = 5 then '312.5' else 'user' || {_K} || '@' ||
            {_pick("'Mail.example','post.example','corp.example','web.example'", f"{_K} % 4")} end as email,
          case when {_K} % 10 = 9 then null when {_K} % 61 = 2 then '312.5' else
            {_pick("'+40','0040 ','0','40'", f"{_K} % 4")} || {_pick("'744','722','772','735','799'", f"{_K} % 5")} || ' ' ||
            lpad(cast({_K} * 131 % 1000 as varchar), 3, '0') || '-' || lpad(cast({_K} * 17 % 1000 as varchar), 3, '0') end
            as phone_number,
          case when {_K} % 20 = 7 then null when {_K} % 71 = 2 then '312.5' else
            {_pick("'Str. ','Strada ','Bd. ','Bulevardul ','Calea ','Aleea '", f"{_K} % 6")} ||
            {_pick("'Mihai Viteazu','Unirii','Florilor','Libertății','Gării'", f"{_K} % 5")} ||
            case when {_K} % 3 = 0 then ', nr. ' when {_K} % 3 = 1 then ' Nr ' else ' ' end || ({_K} % 250 + 1) ||
            case when {_K} % 4 = 1 then ', ap. ' || ({_K} % 80 + 1) else '' end || ', ' || n_name end as address,
          case when {_K} % 41 <> 6 then n_name end as city,
          case when {_K} % 4 = 0 then null when {_K} % 89 = 1 then '312.5' else
            '{{"card_id": "K' || {_K} || '", "issue_date": "' || (2010 + {_K} % 15) || '-0' || ({_K} % 9 + 1) || '-1' ||
            ({_K} % 10) || '", "type": "' || {_pick("'silver','gold','platinum'", f"{_K} % 3")} || '"}}' end as fidelity_card,
          case when {_K} % 12 = 0 then 'persoana_juridica' else 'persoana_fizica' end as customer_type
        from customer join nation on c_nationkey = n_nationkey""",
    "products": """
        select cast(p_partkey as varchar) as product_id, p_name as product_name,
          case when p_partkey % 10 = 0 then 'ALTELE' else p_type end as category,
          case when p_size <= 25 then 0.09::double else 0.19::double end as tva_rate, p_retailprice as base_price,
          case when p_type in ('PROMO', 'SMALL') then 'true' else 'false' end as age_restricted
        from part""",
    "prices": f"""
        select l_orderkey || '-' || l_linenumber as price_id, cast(l_partkey as varchar) as product_id,
          {_SHIPPED} as valid_date, floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 as price
        from lineitem""",
    "discounts": f"""
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey) as discount_id,
          cast(l_partkey as varchar) as product_id, l_discount as discount_percentage,
          {wednesday(_SHIPPED)} as valid_from, cast({wednesday(_SHIPPED)} + 6 as date) as valid_to
        from lineitem""",
    "transactions": """
        select cast(o_orderkey as varchar) as transaction_id, cast(o_custkey as varchar) as customer_id,
          cast(l_partkey as varchar) as product_id, cast(l_quantity as int) as quantity,
          o_orderdate + to_hours(7 + o_orderkey % 15) + to_minutes(o_orderkey % 60) as transaction_date,
          o_orderpriority as payment_method, 'S' || (o_orderkey % 5) as store_id,
          floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 as unit_price_at_purchase
        from lineitem join orders on l_orderkey = o_orderkey""",
    "sales": """
        select cast(event_id as varchar) as transaction_id, cast(user_id as int) as client_id, ts as transaction_date,
          value as amount, 'M' || substr(json_extract_string(props, '$.k'), 1, 1) as merchant,
          case event_type when 'view' then 'groceries' when 'click' then 'Food' when 'signup' then 'transport'
            when 'purchase' then 'shopping' end as category
        from events""",
    "accounts": f"""
        select 'A' || c_custkey as account_id, cast(c_custkey as int) as client_id, c_mktsegment as account_type,
          c_acctbal as opening_balance, timestamp '{DAY} 10:00:00' as open_date
        from customer""",
    "loans": f"""
        select cast(o_orderkey as varchar) as loan_id, cast(o_custkey as int) as client_id,
          o_totalprice / 10 as principal_amount, 1.5::double + (o_orderkey % 106) / 10::double as interest_rate,
          timestamp '{DAY} 09:00:00' as start_date, cast(12 * (1 + o_orderkey % 5) as int) as term_months,
          o_orderpriority as loan_type
        from orders""",
    "delay_fees": f"""
        select l_orderkey || '-' || l_linenumber as fee_id, cast(l_suppkey as int) as client_id,
          cast(l_orderkey as varchar) as loan_id, l_quantity * 10 as fee_amount,
          timestamp '{DAY} 12:00:00' as fee_date, l_linenumber * 13 as days_delayed
        from lineitem""",
    "users": """
        select c_custkey as user_id, n_name as country, date '2024-01-01' as signup_date
        from customer join nation on c_nationkey = n_nationkey""",
    "user_events": "select event_id, user_id, ts as event_time, event_type from events",
    "visits": "select user_id, event_type as page, ts from events",
    "user_sales": """
        select l_suppkey as user_id, l_returnflag as item, l_extendedprice as price, cast(l_quantity as int) as quantity
        from lineitem""",
    "latency_events": """
        select o_orderpriority as dataset, l_returnflag as dataproduct, l_linestatus as mandant,
          o_orderdate as refdate, l_shipdate + to_hours(l_linenumber) as "timestamp"
        from lineitem join orders on l_orderkey = o_orderkey""",
}
