"""DuckDB SQL with the expected result of every registered query.

All statements start with the same chain of common table expressions: the billing projection of
FIXTURES.md, one verdict per raw row, then staging, quarantine and marts.
"""

from __future__ import annotations

import re

from ledgerline.queries import SILENT_CHECKS

AS_OF = "date '2026-12-03'"

RAW = """
raw_customers as (
  select 'C' || lpad(cast(k as varchar), 7, '0') as customer_id,
         case when v = 2 then c_name || ' (old)' else c_name end as customer_name,
         case when k % 97 = 3 then 'not-an-email'
              when k % 83 = 5 then ' user' || cast(k as varchar) || '@example.com'
              when k % 89 = 4 then null
              else 'user' || cast(k as varchar) || '@example.com' end as email,
         case when k % 101 = 7 then null
              when k % 103 = 8 then '  '
              when k % 41 = 6 then ' de '
              else (['DE', 'NL', 'FR', 'SE', 'PL'])[c_nationkey % 5 + 1] end as country,
         case when v = 2 then date '2023-12-31'
              when k % 107 = 9 then date '2999-03-15'
              when k % 2 = 0 then date '2024-01-31'
              else date '2025-06-01' end as created_at
  from (select c_custkey as k, c_name, c_nationkey, 0 as v from customer
        union all select c_custkey, c_name, c_nationkey, 1 from customer where c_custkey % 50 = 1
        union all select c_custkey, c_name, c_nationkey, 2 from customer where c_custkey % 70 = 2)
),
priced_orders as (
  select o_orderkey as k, o_custkey, cast(o_orderdate as date) as start_date,
         case o_orderstatus when 'F' then 'cancelled' when 'O' then 'active' else 'paused' end as base,
         case when o_orderpriority like '1%' then 'scale'
              when o_orderpriority like '2%' or o_orderpriority like '3%' then 'growth'
              else 'starter' end as plan_name
  from orders
  union all
  select o_orderkey, o_custkey, cast(o_orderdate as date),
         case o_orderstatus when 'F' then 'cancelled' when 'O' then 'active' else 'paused' end,
         case when o_orderpriority like '1%' then 'scale'
              when o_orderpriority like '2%' or o_orderpriority like '3%' then 'growth'
              else 'starter' end
  from orders where o_orderkey % 150 = 7
),
raw_subscriptions as (
  select 'S' || lpad(cast(k as varchar), 8, '0') as subscription_id,
         case when k % 211 = 1 then 'C9999999'
              when o_custkey % 47 = 9 then 'C9999998'
              else 'C' || lpad(cast(o_custkey as varchar), 7, '0') end as customer_id,
         plan_name,
         cast(case when k % 199 = 2 then -99
                   when k % 227 = 8 then null
                   when plan_name = 'scale' then 299
                   when plan_name = 'growth' then 99
                   else 29 end as decimal(12, 2)) as monthly_price,
         start_date,
         cast(case when base = 'cancelled' and k % 61 = 5 then start_date - 10
                   when base = 'cancelled' and k % 3 = 0 then start_date + 45
                   when base = 'cancelled' then start_date + 400
                   when base = 'active' and k % 223 = 6 then start_date + 30 end as date) as end_date,
         case when k % 53 = 3 then upper(base)
              when k % 59 = 4 then base || ' '
              else base end as status
  from priced_orders
),
raw_invoices as (
  select 'I' || lpad(cast(l_orderkey as varchar), 8, '0') || '-' || cast(l_linenumber as varchar) as invoice_id,
         case when (l_orderkey + l_linenumber) % 307 = 1 then 'S99999999'
              else 'S' || lpad(cast(l_orderkey as varchar), 8, '0') end as subscription_id,
         cast(l_shipdate as date) as invoice_date,
         case when (l_orderkey + l_linenumber) % 257 = 3 then null
              when (l_orderkey + l_linenumber) % 251 = 2 then cast(-99 as decimal(12, 2))
              else cast(l_extendedprice as decimal(12, 2)) end as amount,
         case when l_suppkey % 20 = 0 then 'SEK'
              when l_suppkey % 33 = 1 then 'USD'
              when l_suppkey % 25 = 2 then ' eur '
              when l_partkey % 191 = 5 then null
              else 'EUR' end as currency,
         case when l_returnflag = 'R' and l_linestatus = 'O' then 'open'
              when l_returnflag = 'R' then 'failed'
              when l_partkey % 71 = 4 then 'PAID '
              else 'paid' end as status
  from lineitem
)"""

# One verdict per raw row. ``staged`` may be NULL: then some rule could not decide.
VERDICTS = f"""
ranked_customers as (
  select *, row_number() over (partition by customer_id order by created_at nulls last,
      email nulls last, customer_name nulls last, country nulls last) as rn,
    email is null or not regexp_matches(email, '^[^[:space:]@]+@[^[:space:]@]+\\.[^[:space:]@]+$') as bad_email,
    coalesce(trim(country), '') = '' as no_country
  from raw_customers
),
judged_customers as (
  select *, rn = 1 as staged,
    case when rn > 1 then 'duplicate_customer_id'
         when bad_email then 'invalid_email'
         when no_country then 'missing_country' end as reason
  from ranked_customers
),
stg_customers as (
  select customer_id, nullif(trim(customer_name), '') as customer_name, nullif(trim(email), '') as email,
    coalesce(nullif(upper(trim(country)), ''), 'UNKNOWN') as country, created_at,
    bad_email as is_invalid_email, no_country as is_missing_country,
    created_at > {AS_OF} as is_future_created_at,
    bad_email or no_country or created_at > {AS_OF} as has_quality_issue
  from judged_customers where staged
),
ranked_subscriptions as (
  select *, row_number() over (partition by subscription_id order by start_date nulls last,
      status nulls last, customer_id nulls last, plan_name nulls last, monthly_price nulls last,
      end_date nulls last) as rn
  from raw_subscriptions
),
judged_subscriptions as (
  select s.*, c.customer_id is null as orphan, monthly_price <= 0 as bad_price,
    coalesce(end_date < start_date, false) as inverted,
    rn = 1 and c.customer_id is not null and monthly_price > 0 as staged,
    case when rn > 1 then 'duplicate_subscription_id'
         when c.customer_id is null then 'orphan_customer_id'
         when monthly_price <= 0 then 'non_positive_monthly_price'
         when end_date < start_date then 'end_before_start' end as reason
  from ranked_subscriptions s left join stg_customers c using (customer_id)
),
stg_subscriptions as (
  select subscription_id, customer_id, lower(trim(plan_name)) as plan_name, monthly_price,
    start_date, end_date, lower(trim(status)) as status, orphan as is_orphan_customer,
    bad_price as is_invalid_price, inverted as is_invalid_date_range,
    orphan or bad_price or inverted as has_quality_issue
  from judged_subscriptions where staged
),
priced_invoices as (
  select i.*, upper(trim(i.currency)) as code, lower(trim(i.status)) as label,
    s.subscription_id is null as orphan, s.customer_id, s.plan_name, s.end_date,
    s.end_date is not null and i.invoice_date > s.end_date as late,
    case upper(trim(i.currency)) when 'EUR' then cast(i.amount as decimal(14, 2))
      when 'SEK' then cast(round(i.amount * 0.087, 2) as decimal(14, 2)) end as eur
  from raw_invoices i left join stg_subscriptions s using (subscription_id)
),
judged_invoices as (
  select *, not orphan and amount > 0 and eur is not null as staged,
    case when amount is null then 'null_amount'
         when amount <= 0 then 'non_positive_amount'
         when code not in ('EUR', 'SEK') then 'unsupported_currency'
         when orphan then 'orphan_subscription_id'
         when late then 'invoice_after_end_date' end as reason
  from priced_invoices
),
stg_invoices as (
  select invoice_id, subscription_id, invoice_date,
    cast(date_trunc('month', invoice_date) as date) as invoice_month, amount as amount_original,
    code as currency_original, eur as amount_eur, 'EUR' as reporting_currency, label as status,
    plan_name, orphan as is_orphan_subscription, amount is null or amount <= 0 as is_invalid_amount,
    late as is_after_end_date,
    orphan or amount is null or amount <= 0 or eur is null or late as has_quality_issue
  from judged_invoices where staged
),
qrt_customers as (
  select customer_id, customer_name, email, country, created_at, reason as quarantine_reason
  from judged_customers where reason is not null
),
qrt_subscriptions as (
  select subscription_id, customer_id, plan_name, monthly_price, start_date, end_date,
    lower(trim(status)) as status, reason as quarantine_reason
  from judged_subscriptions where reason is not null
),
qrt_invoices as (
  select invoice_id, subscription_id, invoice_date, amount, code as currency, label as status,
    reason as quarantine_reason
  from judged_invoices where reason is not null
)"""

MARTS = """
paid as (
  select customer_id, plan_name, cast(date_trunc('month', invoice_date) as date) as invoice_month, eur
  from judged_invoices where staged and label = 'paid' and late is not true
),
mrr_monthly as (
  select invoice_month, plan_name, count(*) as paid_invoice_count,
    cast(sum(eur) as decimal(18, 2)) as mrr_eur
  from paid group by all
),
revenue as (
  select customer_id, cast(sum(eur) as decimal(18, 2)) as ltv_eur, count(*) as paid_invoice_count,
    string_agg(distinct plan_name, ', ' order by plan_name) as plan_mix
  from paid group by all
),
statuses as (
  select customer_id, string_agg(distinct status, ', ' order by status) as subscription_statuses,
    bool_or(status = 'active') as has_active_subscription
  from stg_subscriptions group by all
),
customer_ltv as (
  select customer_id, customer_name, country, coalesce(ltv_eur, cast(0 as decimal(18, 2))) as ltv_eur,
    coalesce(paid_invoice_count, 0) as paid_invoice_count, plan_mix, subscription_statuses,
    coalesce(has_active_subscription, false) as has_active_subscription
  from stg_customers left join revenue using (customer_id) left join statuses using (customer_id)
),
churn_monthly as (
  select cast(date_trunc('month', end_date) as date) as churn_month,
    count(*) as cancelled_subscriptions, cast(sum(monthly_price) as decimal(18, 2)) as mrr_lost_eur
  from stg_subscriptions
  where status = 'cancelled' and end_date is not null and not is_invalid_date_range and monthly_price > 0
  group by all
)"""



def statement(body: str) -> str:
    return f"with {RAW.strip()},\n{VERDICTS.strip()},\n{MARTS.strip()}\n{body.strip()}"


def _summary_row(
    layer: str, table: str, check: str, column: str, severity: str, failures: str
) -> str:
    """One expected check result; ``failures`` is a scalar subquery."""
    return (
        f"select '{layer}' as layer, '{table}' as table_name, '{check}' as check_name, "
        f"'{column}' as column_name, '{severity}' as severity, failures, failures = 0 as passed "
        f"from (select cast(({failures}) as bigint) as failures)"
    )


# Layer, table and relation name in the statements above.
RELATIONS = [
    ("raw", "customers", "raw_customers"),
    ("raw", "subscriptions", "raw_subscriptions"),
    ("raw", "invoices", "raw_invoices"),
    ("staging", "customers", "stg_customers"),
    ("staging", "subscriptions", "stg_subscriptions"),
    ("staging", "invoices", "stg_invoices"),
    ("quarantine", "customers", "qrt_customers"),
    ("quarantine", "subscriptions", "qrt_subscriptions"),
    ("quarantine", "invoices", "qrt_invoices"),
    ("marts", "mrr_monthly", "mrr_monthly"),
    ("marts", "customer_ltv", "customer_ltv"),
    ("marts", "churn_monthly", "churn_monthly"),
]

# Fixed values of the specification.
REQUIRED = {
    "raw_customers": ["customer_id", "email"],
    "raw_subscriptions": ["subscription_id", "customer_id"],
    "raw_invoices": ["invoice_id", "subscription_id"],
    "stg_customers": ["customer_id", "customer_name", "email", "country", "created_at"],
    "stg_subscriptions": ["subscription_id", "customer_id", "plan_name", "monthly_price", "status", "start_date"],
    "stg_invoices": ["invoice_id", "subscription_id", "invoice_date", "amount_eur", "status", "plan_name"],
    "qrt_customers": ["customer_id", "quarantine_reason"],
    "qrt_subscriptions": ["subscription_id", "quarantine_reason"],
    "qrt_invoices": ["invoice_id", "quarantine_reason"],
    "mrr_monthly": ["invoice_month", "plan_name", "paid_invoice_count", "mrr_eur"],
    "customer_ltv": ["customer_id", "customer_name", "country", "ltv_eur", "paid_invoice_count", "has_active_subscription"],
    "churn_monthly": ["churn_month", "cancelled_subscriptions", "mrr_lost_eur"],
}

DOMAINS = [
    ("stg_customers", "country", ["DE", "NL", "FR", "ES", "SE", "IT", "NO", "PT", "FI", "PL", "UNKNOWN"]),
    ("stg_subscriptions", "plan_name", ["starter", "growth", "scale"]),
    ("stg_subscriptions", "status", ["active", "cancelled", "paused"]),
    ("stg_invoices", "status", ["paid", "failed", "open"]),
    ("stg_invoices", "reporting_currency", ["EUR"]),
    ("stg_invoices", "plan_name", ["starter", "growth", "scale"]),
    ("qrt_customers", "quarantine_reason", ["duplicate_customer_id", "invalid_email", "missing_country", "other"]),
    (
        "qrt_subscriptions",
        "quarantine_reason",
        ["duplicate_subscription_id", "orphan_customer_id", "non_positive_monthly_price", "end_before_start", "other"],
    ),
    (
        "qrt_invoices",
        "quarantine_reason",
        ["orphan_subscription_id", "null_amount", "non_positive_amount", "unsupported_currency", "invoice_after_end_date", "other"],
    ),
    ("mrr_monthly", "plan_name", ["starter", "growth", "scale"]),
]

BOUNDS = [
    ("stg_subscriptions", "monthly_price", "> 0"),
    ("stg_invoices", "amount_eur", "> 0"),
    ("mrr_monthly", "mrr_eur", ">= 0"),
    ("customer_ltv", "ltv_eur", ">= 0"),
    ("churn_monthly", "mrr_lost_eur", ">= 0"),
]

KEYS = [
    ("raw_customers", "customer_id", "warn"),
    ("raw_subscriptions", "subscription_id", "warn"),
    ("raw_invoices", "invoice_id", "error"),
    ("stg_customers", "customer_id", "error"),
    ("stg_subscriptions", "subscription_id", "error"),
    ("stg_invoices", "invoice_id", "error"),
    ("customer_ltv", "customer_id", "error"),
]

REFERENCES = [
    ("raw_subscriptions", "customer_id", "raw_customers", "warn"),
    ("raw_invoices", "subscription_id", "raw_subscriptions", "warn"),
    ("stg_subscriptions", "customer_id", "stg_customers", "error"),
    ("stg_invoices", "subscription_id", "stg_subscriptions", "error"),
]

CLASSES = {
    "duplicate_customer_id": ("qrt_customers", ["duplicate_customer_id"]),
    "invalid_email": ("qrt_customers", ["invalid_email"]),
    "missing_country": ("qrt_customers", ["missing_country"]),
    "duplicate_subscription_id": ("qrt_subscriptions", ["duplicate_subscription_id"]),
    "orphan_customer_id": ("qrt_subscriptions", ["orphan_customer_id"]),
    "non_positive_monthly_price": ("qrt_subscriptions", ["non_positive_monthly_price"]),
    "end_before_start": ("qrt_subscriptions", ["end_before_start"]),
    "orphan_subscription_id": ("qrt_invoices", ["orphan_subscription_id"]),
    "null_or_non_positive_amount": ("qrt_invoices", ["null_amount", "non_positive_amount"]),
    "invoice_after_end_date": ("qrt_invoices", ["invoice_after_end_date"]),
}

_PLACE = {relation: (layer, table) for layer, table, relation in RELATIONS}


def _quoted(words: list[str]) -> str:
    return ", ".join(f"'{word}'" for word in words)


def _not_null_rows() -> list[str]:
    return [
        _summary_row(
            *_PLACE[rel], "not_null", c, "error", f"select count(*) from {rel} where {c} is null"
        )
        for rel, columns in REQUIRED.items()
        for c in columns
    ]


def _accepted_rows() -> list[str]:
    return [
        _summary_row(
            *_PLACE[rel],
            "accepted_values",
            c,
            "error",
            f"select count(*) from {rel} where {c} not in ({_quoted(values)})",
        )
        for rel, c, values in DOMAINS
    ]


def _expression_rows() -> list[str]:
    return [
        _summary_row(
            *_PLACE[rel],
            "expression_is_true",
            c,
            "error",
            f"select count(*) from {rel} where not ({c} {bound})",
        )
        for rel, c, bound in BOUNDS
    ]


def _repeated(relation: str, key: str) -> str:
    return (
        f"select {key}, count(*) as row_count from {relation} where {key} is not null "
        f"group by {key} having count(*) > 1"
    )


def _dangling(child: str, key: str, parent: str) -> str:
    return (
        f"select c.{key} from {child} c where c.{key} is not null "
        f"and not exists (select 1 from {parent} p where p.{key} = c.{key})"
    )


RAW_AMOUNTS = "select invoice_id, amount, status from raw_invoices where amount is null or amount <= 0"
RAW_DATES = "select subscription_id, start_date, end_date from raw_subscriptions where end_date < start_date"
ACTIVE_ENDED = (
    "select subscription_id, status, end_date from stg_subscriptions "
    "where status = 'active' and end_date is not null"
)
DATES_FLAGGED = (
    "select subscription_id, start_date, end_date from stg_subscriptions "
    "where end_date < start_date and not is_invalid_date_range"
)
PAID_POSITIVE = (
    "select invoice_id, amount_eur, status from stg_invoices where status = 'paid' and amount_eur <= 0"
)
AFTER_END = (
    "select i.invoice_id, i.invoice_date, s.end_date from stg_invoices i "
    "join stg_subscriptions s using (subscription_id) where i.status = 'paid' "
    "and i.invoice_date > s.end_date and i.is_after_end_date is not true"
)
DROPPED_SUBSCRIPTIONS = (
    "select 'subscriptions' as table_name, subscription_id as row_key, reason as quarantine_reason "
    "from judged_subscriptions where rn = 1 and not orphan and monthly_price is null"
)
DROPPED_INVOICES = (
    "select 'invoices' as table_name, invoice_id as row_key, reason as quarantine_reason "
    "from judged_invoices where amount > 0 and code is null and not orphan"
)
UNIQUE_MRR = (
    "select 'mrr_monthly' as table_name, invoice_month as month, plan_name, count(*) as row_count "
    "from mrr_monthly group by all having count(*) > 1"
)
UNIQUE_CHURN = (
    "select 'churn_monthly' as table_name, churn_month as month, cast(null as varchar) as plan_name, "
    "count(*) as row_count from churn_monthly group by all having count(*) > 1"
)
PLANTED = " union all ".join(
    f"select '{name}' as missing_quarantine_reason from (select count(*) as n from {rel} "
    f"where quarantine_reason in ({_quoted(reasons)})) where n = 0"
    for name, (rel, reasons) in CLASSES.items()
)


def _summary() -> str:
    def counted(place, check, column, severity, rows):
        return _summary_row(*place, check, column, severity, f"select count(*) from ({rows})")

    rows = [*_not_null_rows(), *_accepted_rows(), *_expression_rows()]
    rows += [counted(_PLACE[r], "unique", k, sev, _repeated(r, k)) for r, k, sev in KEYS]
    rows += [
        counted(_PLACE[c], "relationships", k, sev, _dangling(c, k, p))
        for c, k, p, sev in REFERENCES
    ]
    rows += [
        counted(
            ("marts", "mrr_monthly"), "unique_combination", "invoice_month, plan_name", "error", UNIQUE_MRR
        ),
        counted(("marts", "churn_monthly"), "unique_combination", "churn_month", "error", UNIQUE_CHURN),
        counted(("raw", "invoices"), "raw_amounts_sane", "amount", "warn", RAW_AMOUNTS),
        counted(("raw", "subscriptions"), "raw_dates_sane", "end_date", "warn", RAW_DATES),
        counted(("staging", "subscriptions"), "active_without_end", "end_date", "error", ACTIVE_ENDED),
        counted(("staging", "subscriptions"), "dates_flagged", "end_date", "error", DATES_FLAGGED),
        counted(("staging", "invoices"), "paid_positive", "amount_eur", "error", PAID_POSITIVE),
        counted(("staging", "invoices"), "after_end_flagged", "invoice_date", "error", AFTER_END),
        counted(("staging", "customers"), "silent_drops", "customer_id", "warn", "select 1 where false"),
        counted(("staging", "subscriptions"), "silent_drops", "subscription_id", "warn", DROPPED_SUBSCRIPTIONS),
        counted(("staging", "invoices"), "silent_drops", "invoice_id", "warn", DROPPED_INVOICES),
        counted(("quarantine", "all"), "planted_defects", "quarantine_reason", "error", PLANTED),
    ]
    return "\nunion all ".join(rows)


BODIES: dict[str, str] = {
    "load_raw_customers": "select * from raw_customers",
    "load_raw_subscriptions": "select * from raw_subscriptions",
    "load_raw_invoices": "select * from raw_invoices",
    "row_count_reconcile": """
        select table_name, n as source_rows, n as loaded_rows, true as matches from (
          select 'customers' as table_name, count(*) as n from raw_customers
          union all select 'subscriptions', count(*) from raw_subscriptions
          union all select 'invoices', count(*) from raw_invoices)""",
    "stg_customers": "select * from stg_customers",
    "stg_subscriptions": "select * from stg_subscriptions",
    "stg_invoices": "select * from stg_invoices",
    "qrt_customers": "select * from qrt_customers",
    "qrt_subscriptions": "select * from qrt_subscriptions",
    "qrt_invoices": "select * from qrt_invoices",
    "mrr_monthly": "select * from mrr_monthly",
    "customer_ltv": "select * from customer_ltv",
    "churn_monthly": "select * from churn_monthly",
    "dedupe_customers": """
        select customer_id, customer_name, email, country, created_at from ranked_customers where rn = 1""",
    "dedupe_subscriptions": """
        select subscription_id, customer_id, plan_name, monthly_price, start_date, end_date, status
        from ranked_subscriptions where rn = 1""",
    "duplicate_customers": """
        select customer_id, customer_name, email, country, created_at from ranked_customers where rn > 1""",
    "duplicate_subscriptions": """
        select subscription_id, customer_id, plan_name, monthly_price, start_date, end_date, status
        from ranked_subscriptions where rn > 1""",
    "normalize_strings": """
        select customer_id as row_key, 'customer_name' as column_name,
          nullif(trim(customer_name), '') as value from raw_customers
        union all select customer_id, 'email', nullif(trim(email), '') from raw_customers
        union all select customer_id, 'country', coalesce(nullif(upper(trim(country)), ''), 'UNKNOWN')
          from raw_customers
        union all select subscription_id, 'plan_name', lower(trim(plan_name)) from raw_subscriptions
        union all select subscription_id, 'status', lower(trim(status)) from raw_subscriptions""",
    "fx_normalize": """
        select invoice_id, amount, upper(trim(currency)) as currency_code,
          case upper(trim(currency)) when 'EUR' then cast(amount as decimal(14, 2))
            when 'SEK' then cast(round(amount * 0.087, 2) as decimal(14, 2)) end as amount_eur
        from raw_invoices""",
    "flag_invalid_email": "select customer_id, email, is_invalid_email from stg_customers",
    "flag_missing_country": "select customer_id, country, is_missing_country from stg_customers",
    "flag_future_created_at": "select customer_id, created_at, is_future_created_at from stg_customers",
    "flag_invalid_date_range": """
        select subscription_id, end_date, is_invalid_date_range from stg_subscriptions""",
    "orphan_subscriptions": """
        select subscription_id, customer_id from judged_subscriptions where rn = 1 and orphan""",
    "orphan_invoices": "select invoice_id, subscription_id from judged_invoices where orphan",
    "invoices_after_end": """
        select invoice_id, subscription_id, invoice_date, end_date from judged_invoices where late""",
    "unsupported_currency": """
        select invoice_id, currency, amount from raw_invoices
        where upper(trim(currency)) not in ('EUR', 'SEK')""",
    "quality_issue_rate": """
        select table_name, count(*) as row_count,
          count(*) filter (where bad) as issue_count,
          cast(count(*) filter (where bad) as double) / cast(count(*) as double) as issue_rate
        from (select 'customers' as table_name, has_quality_issue as bad from stg_customers
              union all select 'subscriptions', has_quality_issue from stg_subscriptions
              union all select 'invoices', has_quality_issue from stg_invoices)
        group by table_name""",
    "quarantine_reason_counts": """
        select table_name, quarantine_reason, count(*) as row_count
        from (select 'customers' as table_name, quarantine_reason from qrt_customers
              union all select 'subscriptions', quarantine_reason from qrt_subscriptions
              union all select 'invoices', quarantine_reason from qrt_invoices)
        group by all""",
    "customer_revenue": "select customer_id, ltv_eur, paid_invoice_count from revenue",
    "customer_plan_mix": "select customer_id, plan_mix from revenue",
    "customer_status_mix": "select * from statuses",
    "check_not_null": "\nunion all ".join(_not_null_rows()),
    "check_accepted_values": "\nunion all ".join(_accepted_rows()),
    "check_expression": "\nunion all ".join(_expression_rows()),
    **{
        f"check_unique_{relation}": _repeated(relation, key)
        for relation, key, _ in KEYS
    },
    "check_unique_combination": f"{UNIQUE_MRR} union all {UNIQUE_CHURN}",
    **{
        f"check_relationships_{child}": _dangling(child, key, parent)
        for child, key, parent, _ in REFERENCES
    },
    "check_active_without_end": ACTIVE_ENDED,
    "check_paid_positive": PAID_POSITIVE,
    "check_dates_flagged": DATES_FLAGGED,
    "check_raw_amounts": RAW_AMOUNTS,
    "check_raw_dates": RAW_DATES,
    "check_after_end_flagged": AFTER_END,
    "check_planted_defects": PLANTED,
    "check_silent_drops": f"{DROPPED_SUBSCRIPTIONS} union all {DROPPED_INVOICES}",
    "check_summary": _summary(),
    "profile_grain": """
        select 'customers' as table_name, count(*) as row_count,
          count(distinct customer_id) as distinct_keys from raw_customers
        union all select 'subscriptions', count(*), count(distinct subscription_id) from raw_subscriptions
        union all select 'invoices', count(*), count(distinct invoice_id) from raw_invoices""",
    "profile_multi_subscription": """
        select customer_id, count(*) as subscription_count,
          count(*) filter (where status = 'active') as active_count
        from stg_subscriptions group by customer_id having count(*) > 1""",
    "profile_subscriptions_without_invoices": """
        select subscription_id, plan_name, start_date from stg_subscriptions
        where subscription_id not in
          (select subscription_id from raw_invoices where subscription_id is not null)""",
    "profile_duplicate_billing": """
        select subscription_id, invoice_date, count(*) as invoice_count from raw_invoices
        group by all having count(*) > 1""",
    "profile_price_mismatch": """
        select i.invoice_id, i.subscription_id, i.amount, s.monthly_price
        from raw_invoices i join stg_subscriptions s using (subscription_id)
        where i.amount is distinct from s.monthly_price""",
    "profile_status_share": """
        select table_name, status, n as row_count,
          cast(n as double) / cast(sum(n) over (partition by table_name) as double) as share
        from (select 'subscriptions' as table_name, lower(trim(status)) as status, count(*) as n
              from raw_subscriptions group by 2
              union all select 'invoices', lower(trim(status)), count(*) from raw_invoices group by 2)""",
    "profile_domains": """
        select 'customers' as table_name, 'country' as column_name, country as value, count(*) as row_count
        from raw_customers group by country
        union all
        select 'subscriptions', 'plan_name, monthly_price',
          concat_ws(' @ ', plan_name, cast(monthly_price as varchar)), count(*)
        from raw_subscriptions group by plan_name, monthly_price
        union all select 'subscriptions', 'status', status, count(*) from raw_subscriptions group by status
        union all select 'invoices', 'currency', currency, count(*) from raw_invoices group by currency
        union all select 'invoices', 'status', status, count(*) from raw_invoices group by status""",
    "profile_future_dates": f"""
        select 'customer_created' as event, customer_id as entity_id, created_at as event_date
        from stg_customers where created_at > {AS_OF}
        union all select 'subscription_cancelled', subscription_id, end_date from stg_subscriptions
        where status = 'cancelled' and end_date > {AS_OF}""",
    "revenue_share_by_plan": """
        select plan_name, paid_invoice_count, revenue_eur,
          cast(revenue_eur as double)
            / cast(cast(sum(revenue_eur) over () as decimal(18, 2)) as double) as share
        from (select plan_name, cast(sum(paid_invoice_count) as bigint) as paid_invoice_count,
                cast(sum(mrr_eur) as decimal(18, 2)) as revenue_eur
              from mrr_monthly group by plan_name)""",
    "top_countries": """
        select country, cast(sum(ltv_eur) as decimal(18, 2)) as revenue_eur, count(*) as customers
        from customer_ltv group by country order by revenue_eur desc, country limit 5""",
    "ltv_distribution": """
        select count(*) as customers, min(ltv_eur) as min_ltv_eur,
          cast((max(ltv_eur) filter (where place = (n + 1) // 2)
              + max(ltv_eur) filter (where place = n // 2 + 1)) * 0.5 as decimal(18, 3)) as median_ltv_eur,
          max(ltv_eur) as max_ltv_eur
        from (select ltv_eur, row_number() over (order by ltv_eur) as place, count(*) over () as n
              from customer_ltv)""",
    "unique_across_deliveries": """
        select invoice_id, count(*) as row_count from raw_invoices where invoice_id is not null
        group by invoice_id having count(*) > 1""",
    "paid_amount_sketches": """
        select invoice_month, plan_name, count(*) as invoices, true as quartiles_hold from paid
        where eur is not null group by all""",
    "quarantine_spikes": """
        , r as (
          select unnest(['orphan_subscription_id', 'null_amount', 'non_positive_amount', 'unsupported_currency',
            'invoice_after_end_date', 'other']) as quarantine_reason),
        m as (select cast(year(invoice_date) * 100 + month(invoice_date) as bigint) as run, count(*) as table_rows
              from judged_invoices where invoice_date is not null group by 1),
        c as (
          select 'invoices' as table_name, quarantine_reason, run, table_rows,
            (select count(*) from judged_invoices j where year(invoice_date) * 100 + month(invoice_date) = run
               and j.reason = quarantine_reason) as row_count
          from m, r),
        p as (select *, cast(row_count * 1000000 // table_rows as double) as per_million from c),
        w as (
          select *, coalesce(list(per_million) over (partition by quarantine_reason order by run
            rows between 12 preceding and 1 preceding), []) as before from p),
        s as (
          select table_name, quarantine_reason, run, row_count, table_rows, per_million,
            cast(len(before) as integer) as earlier_runs, list_aggregate(before, 'median') as usual,
            list_aggregate(before, 'mad') as spread
          from w)
        select *, case when earlier_runs >= 5 then usual + greatest(spread * (5.0::double * 1.4826::double), usual * 0.5::double, 1000.0::double) end as upper,
          coalesce(per_million > upper, false) as is_spike
        from s""",
    "active_book_by_plan": """
        select plan_name, count(*) as active_subscriptions,
          cast(sum(monthly_price) as decimal(18, 2)) as list_price_eur
        from stg_subscriptions where status = 'active' group by plan_name""",
}


# The last change of each invoice, base rows being change 0; all else as over the raw invoices.
CHANGED = """
changes as (
  select case when kind = 'new' then 'N' else '' end
           || 'I' || lpad(cast(l_orderkey as varchar), 8, '0') || '-' || cast(l_linenumber as varchar) as invoice_id,
         'S' || lpad(cast(l_orderkey as varchar), 8, '0') as subscription_id,
         case when kind = 'moved' then cast(l_shipdate as date) + 40 else cast(l_shipdate as date) end as invoice_date,
         cast(case when kind = 'moved' then l_extendedprice + 10 else l_extendedprice end as decimal(12, 2)) as amount,
         'EUR' as currency, case when kind = 'failed' then 'failed' else 'paid' end as status,
         seq, kind = 'deleted' as is_deleted
  from lineitem join (values ('moved', 40, 7, 2), ('deleted', 61, 13, 3), ('new', 97, 11, 1), ('failed', 80, 7, 4),
                             ('late', 60, 27, 1), ('back', 183, 13, 5)) as k(kind, every, rest, seq)
    on (l_orderkey + l_linenumber) % every = rest
),
last_changes as (
  select *, row_number() over (partition by invoice_id order by seq desc, is_deleted desc, subscription_id desc nulls last,
      invoice_date desc nulls last, amount desc nulls last, currency desc nulls last, status desc nulls last) as place
  from (select *, 0 as seq, false as is_deleted from base_invoices union all select * from changes)
),
raw_invoices as (
  select invoice_id, subscription_id, invoice_date, amount, currency, status
  from last_changes where place = 1 and not is_deleted
)"""

CHANGED_BODIES: dict[str, str] = {
    "incremental_invoices": "select * from raw_invoices",
    "incremental_mrr_monthly": "select * from mrr_monthly",
    "incremental_customer_ltv": "select * from customer_ltv",
    "incremental_check_results": f"""
        select * from ({_summary()}) where table_name = 'invoices' and check_name not in ('unique', 'relationships')""",
}


# Snapshots of subscriptions; an interval ends where a snapshot no longer shows the same.
HISTORY = """
drawn as (
  select o_orderkey as k, s, 'C' || lpad(cast(o_custkey as varchar), 7, '0') as customer_id,
         case when o_orderkey % 11 = 3 and s >= 2 + o_orderkey % 5 then 'scale'
              when o_orderpriority like '1%' then 'scale'
              when o_orderpriority like '2%' or o_orderpriority like '3%' then 'growth'
              else 'starter' end as plan_name
  from orders, range(0, 8) as r(s)
  where s >= o_orderkey % 3 and not (o_orderkey % 37 = 5 and s = 3 + o_orderkey % 4)
    and not (o_orderkey % 41 = 7 and s >= 6)
),
shown as (
  select 'S' || lpad(cast(k as varchar), 8, '0') as subscription_id, customer_id, plan_name,
         cast(case plan_name when 'scale' then 299 when 'growth' then 99 else 29 end
              + case when k % 13 = 6 and s >= 4 then 10 else 0 end
              + case when k % 150 = 7 then 1 else 0 end as decimal(12, 2)) as monthly_price,
         case when k % 19 = 2 and s >= 5 then 'cancelled'
              when k % 17 = 9 and s in (2, 5) then 'paused' else 'active' end as status,
         date '2026-01-10' + cast(25 * s as integer) as day
  from drawn
),
stepped as (
  select *, lag(day) over w is distinct from day - 25
         or (lag(customer_id) over w, lag(plan_name) over w, lag(monthly_price) over w, lag(status) over w)
            is distinct from (customer_id, plan_name, monthly_price, status) as starts
  from shown window w as (partition by subscription_id order by day)
),
stretched as (select *, count(*) filter (where starts) over (partition by subscription_id order by day) as stretch from stepped),
history as (
  select subscription_id, customer_id, plan_name, monthly_price, status, min(day) as valid_from,
         case when max(day) < date '2026-07-04' then max(day) + 25 end as valid_to
  from stretched group by subscription_id, stretch, customer_id, plan_name, monthly_price, status
)"""

RATES = """
rate_days as (
  select cast(o_orderdate as date) as valid_from, count(*) as c, cast(o_orderdate as date) - date '1970-01-01' as n
  from orders group by all
),
rates as (
  select currency_code, valid_from as rate_date, max(rate) as rate from (
    select 'SEK' as currency_code, valid_from, cast(0.08 + c % 50 / 1000 as decimal(12, 6)) as rate from rate_days where n % 9 = 2
    union all select 'SEK', valid_from, cast(0.07 + c % 90 / 1000 as decimal(12, 6)) from rate_days where n % 18 = 2
    union all select 'USD', valid_from, cast(0.9 + c % 7 / 100 as decimal(12, 6)) from rate_days where n % 100 = 50 and n % 700 < 400)
  group by all
),
coded as (select *, upper(trim(currency)) as currency_code from raw_invoices),
met as (
  select c.*, case when c.invoice_date - r.rate_date <= 30 then r.rate_date end as rate_date,
         case when c.invoice_date - r.rate_date <= 30 then r.rate end as rate
  from coded c asof left join rates r on c.currency_code = r.currency_code and c.invoice_date >= r.rate_date
),
priced as (
  select invoice_id, invoice_date, amount, currency_code, rate_date, rate,
         cast(case when currency_code = 'EUR' then amount else round(amount * rate, 2) end as decimal(14, 2)) as amount_eur
  from met
)"""

HISTORY_BODIES: dict[str, str] = {
    "subscription_history": "select * from history",
    "subscription_history_by_snapshot": "select * from history",
    "book_mrr_monthly": """
        , begun as (
          select plan_name, monthly_price, cast(date_trunc('month', valid_from + interval 1 month - interval 1 day) as date) as low,
            cast(date_trunc('month', valid_to + interval 1 month - interval 1 day) as date) as high
          from history where status = 'active' and monthly_price > 0
        ),
        months as (select cast(m as date) as book_month from range(date '2026-01-01', date '2027-01-01', interval 1 month) as r(m)),
        plans as (select plan_name, min(low) as first from begun where high is null or low < high group by all)
        select p.plan_name, book_month,
          count(*) filter (where low <= book_month and (high is null or high > book_month)) as active_subscriptions,
          cast(coalesce(sum(monthly_price) filter (where low <= book_month and (high is null or high > book_month)), 0) as decimal(18, 2)) as book_mrr_eur,
          cast(coalesce(sum(monthly_price) filter (where low = book_month), 0) as decimal(18, 2)) as gained_eur,
          cast(coalesce(sum(monthly_price) filter (where high = book_month), 0) as decimal(18, 2)) as lost_eur
        from plans p join months on book_month >= first
          left join begun b on b.plan_name = p.plan_name and (high is null or low < high)
        group by all""",
}

RATE_BODIES: dict[str, str] = {
    "invoices_at_dated_rates": "select * from priced",
    "missing_rates": """
        select currency_code, cast(date_trunc('month', invoice_date) as date) as invoice_month, count(*) as invoices,
          cast(sum(amount) as decimal(18, 2)) as amount
        from priced where amount_eur is null and amount is not null and currency_code is not null group by all""",
}


# Tables as a faulty build would leave them; checks on them read these instead.
BROKEN = """
bad_stg_customers as (
  select c.* from stg_customers c, range(case when customer_id like '%3' then 2 else 1 end) where customer_id not like '%55'
),
bad_stg_subscriptions as (
  select s.* replace (false as is_invalid_date_range)
  from stg_subscriptions s, range(case when subscription_id like '%77' then 2 else 1 end) where subscription_id not like '%5'
),
bad_stg_invoices as (
  select * replace (case when invoice_id like '%9-2' then -amount_eur else amount_eur end as amount_eur) from stg_invoices
),
late_stg_invoices as (
  select * replace (is_after_end_date and invoice_id not like '%-1' as is_after_end_date) from stg_invoices
),
bad_qrt_customers as (select * from qrt_customers where quarantine_reason <> 'invalid_email'),
bad_qrt_subscriptions as (select * from qrt_subscriptions where quarantine_reason <> 'end_before_start'),
bad_customer_ltv as (select l.* from customer_ltv l, range(case when customer_id like '%8' then 2 else 1 end)),
bad_mrr_monthly as (select m.* from mrr_monthly m, range(case when plan_name = 'growth' then 2 else 1 end)),
bad_churn_monthly as (select c.* from churn_monthly c, range(case when month(churn_month) = 1 then 2 else 1 end))"""


def _on_broken(body: str, own: dict[str, str]) -> str:
    """A check's SQL over the broken tables, or over those named in ``own``."""
    names = {n: f"bad_{n}" for n in re.findall(r"\bbad_(\w+) as", BROKEN)} | own
    body = re.sub(rf"\b({'|'.join(names)})\b(?!')", lambda m: names[m[0]], body)
    return f"with {RAW.strip()},\n{VERDICTS.strip()},\n{MARTS.strip()},\n{BROKEN.strip()}\n{body.strip()}"


#: Tables that a check on the faulty build reads unbroken, or broken in another way.
UNBROKEN = {"check_after_end_flagged": {"stg_invoices": "late_stg_invoices", "stg_subscriptions": "stg_subscriptions"}}


def _after_changes(body: str) -> str:
    base = RAW.strip().replace("raw_invoices as (", "base_invoices as (")
    return f"with {base},\n{CHANGED.strip()},\n{VERDICTS.strip()},\n{MARTS.strip()}\n{body}"


def expected_sql() -> dict[str, str]:
    changed = {name: _after_changes(body) for name, body in CHANGED_BODIES.items()}
    history = {name: f"with {HISTORY.strip()}\n{body.strip()}" for name, body in HISTORY_BODIES.items()}
    rates = {name: f"with {RAW.strip()},\n{RATES.strip()}\n{body.strip()}" for name, body in RATE_BODIES.items()}
    broken = {f"broken_{name}": _on_broken(BODIES[name], UNBROKEN.get(name, {})) for name in SILENT_CHECKS}
    return {name: statement(body) for name, body in BODIES.items()} | changed | history | rates | broken
