"""Feature operators on the sales table."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import features as f
from marketloom.plans.transform import LAGS, transform_sales
from marketloom.queries.fixtures import KEYS, ORDER, mean, money, on_raw, on_sales, raw_sales, sales
from marketloom.schema import LAG_PERIODS, ROLLING_WINDOWS, TARGET, TEXT_COLUMNS
from marketloom.session import durable

FUNCTIONS = ["mean", "std", "min", "max", "sum"]
_K = ", ".join(KEYS)
_O = ", ".join(ORDER)


def _rounded(df, *parts, places=2):
    """Sums of doubles and standard deviations are rounded: engines add in different orders."""
    return df.withColumns({c: F.round(c, places) for c in df.columns if any(p in c for p in parts)})


def _slim(s, d, *columns):
    return sales(s, d).select(*dict.fromkeys([*ORDER, *columns]))


def _lag(groups):
    return lambda s, d: f.lag_features(durable(_slim(s, d, "customer_id", "total_amount"), "sales"), "total_amount", ORDER, groups=groups)


def _rolling(groups):
    def query(s, d):
        slim = durable(_slim(s, d, "customer_id", "total_amount"), "sales")
        out = f.rolling_features(slim, "total_amount", ORDER, groups=groups, functions=FUNCTIONS)
        return _rounded(_rounded(out, "_std_"), "_mean_", "_sum_", places=6)

    return query


def _dates(s, d):
    dated = _slim(s, d).withColumn("invoice_date", F.when(F.col("l_orderkey") % 31 != 0, F.col("invoice_date")))
    return f.date_features(dated, "invoice_date")


def _onehot(s, d):
    raw = raw_sales(s, d).select(*KEYS, "payment_method", "gender")
    encoded = f.onehot_encode(raw.withColumn("gender", F.lower(F.trim("gender"))), ["gender", "payment_method"])
    flags = [c for c, t in encoded.dtypes if t == "boolean"]
    return encoded.withColumns({c: F.col(c).cast("int") for c in flags})


def _ratio(s, d):
    raw = raw_sales(s, d).select(*KEYS, "price", "quantity", "age")
    per_year = f.ratio_feature(raw, "price", "quantity")
    zero = per_year.withColumn("decade_rest", F.col("age") % 10)
    return f.ratio_feature(zero, "quantity", "decade_rest", "quantity_per_rest")


def _category_rank(s, d):
    return f.category_table(sales(s, d)).select("category", "category_total_amount", "category_rank")


def _transform(s, d):
    return _rounded(transform_sales(durable(sales(s, d), "sales"), ORDER), "std")


def _transform_without(s, d, *columns):
    """The job on a table that lacks optional columns."""
    slim = sales(s, d).drop(*columns).select(*ORDER, *[c for c in ("customer_id", "category", "invoice_no", "quantity", "price", TARGET) if c not in columns])
    return _rounded(transform_sales(durable(slim, "sales"), ORDER), "std")


QUERIES = {
    "lag_grouped": _lag(["customer_id"]),
    "lag_global": _lag([]),
    "rolling_grouped": _rolling(["customer_id"]),
    "rolling_global": _rolling([]),
    "date_features": _dates,
    "encode_label": lambda s, d: f.label_encode(
        durable(raw_sales(s, d).select(*KEYS, *TEXT_COLUMNS, "quantity", "price"), "raw"), [*TEXT_COLUMNS, "quantity", "price"]
    ),
    "encode_onehot": _onehot,
    "encode_frequency": lambda s, d: f.frequency_encode(raw_sales(s, d).select(*KEYS, "category", "loyalty_tier"), ["category", "loyalty_tier"]),
    "group_aggregates": lambda s, d: _rounded(
        f.group_features(
            raw_sales(s, d).select(*KEYS, "category", "gender", "price"), ["category", "gender"], "price"
        ),
        "_std_",
        "_mean_",
        "_sum_",
    ),
    "ratio_feature": _ratio,
    "rfm_features": lambda s, d: f.customer_features(
        durable(_slim(s, d, "customer_id", "invoice_no", "total_amount"), "sales"), names=["recency", "frequency", "monetary"]
    ),
    "customer_stats": lambda s, d: _rounded(
        f.customer_features(
            durable(_slim(s, d, "customer_id", "invoice_no", "total_amount", "quantity"), "sales"),
            names=[
                "customer_avg_amount",
                "customer_std_amount",
                "customer_min_amount",
                "customer_max_amount",
                "customer_avg_quantity",
                "customer_total_quantity",
            ],
        ),
        "_std_",
    ),
    "category_stats": lambda s, d: f.category_features(_slim(s, d, "category", "total_amount", "quantity")).drop("category_rank"),
    "category_rank": _category_rank,
    "price_vs_category": lambda s, d: f.price_vs_category(raw_sales(s, d).select(*KEYS, "category", "price")),
    "customer_ltv": lambda s, d: f.customer_ltv(_slim(s, d, "customer_id", "total_amount")),
    "transform_sales": _transform,
    "transform_without_category": lambda s, d: _transform_without(s, d, "category"),
    "transform_without_customer": lambda s, d: _transform_without(s, d, "customer_id", "price"),
}


def _lag_sql(partition: str) -> str:
    lags = ", ".join(
        f"lag(total_amount, {n}) OVER ({partition} ORDER BY {_O}) AS total_amount_lag_{n}" for n in LAG_PERIODS
    )
    return on_sales(f"SELECT {_O}, customer_id, total_amount, {lags} FROM sales")


def _roll(name: str, column: str, over: str, exact: bool) -> str:
    if name == "mean":
        return mean(column, over) if exact else f"round(avg({column}){over}, 6)"
    if name == "sum":
        return money(column, over) if exact else f"round(sum({column}){over}, 6)"
    if name == "std":
        return f"round(stddev_samp({column}){over}, 2)"
    return f"{name}({column}){over}"


def _rolling_columns(partition: str, functions, exact: bool = True) -> str:
    return ", ".join(
        _roll(x, "total_amount", f" OVER ({partition} ORDER BY {_O} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)", exact)
        + f" AS total_amount_rolling_{x}_{w}"
        for w in ROLLING_WINDOWS
        for x in functions
    )


def _rolling_sql(partition: str) -> str:
    return on_sales(f"SELECT {_O}, customer_id, total_amount, {_rolling_columns(partition, FUNCTIONS, False)} FROM sales")


_PARTS = """CAST(year(D) AS INTEGER) AS year, CAST(month(D) AS INTEGER) AS month, CAST(day(D) AS INTEGER) AS day,
    CAST(isodow(D) - 1 AS INTEGER) AS day_of_week, CAST(dayofyear(D) AS INTEGER) AS day_of_year,
    CAST(week(D) AS INTEGER) AS week_of_year, CAST(quarter(D) AS INTEGER) AS quarter,
    CASE WHEN isodow(D) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN day(D) = 1 THEN 1 ELSE 0 END AS is_month_start,
    CASE WHEN last_day(D) = CAST(D AS DATE) THEN 1 ELSE 0 END AS is_month_end,
    CASE WHEN month(D) IN (12, 1, 2) THEN 1 WHEN month(D) IN (3, 4, 5) THEN 2 WHEN month(D) IN (6, 7, 8) THEN 3 ELSE 4 END AS season"""


def _label(column: str) -> str:
    return f"""CAST(CASE WHEN {column} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {column} NULLS LAST) - 1 END AS INTEGER)
        AS {column}_encoded"""


def _freq(column: str) -> str:
    return f"""CASE WHEN {column} IS NOT NULL THEN CAST(count({column}) OVER (PARTITION BY {column}) AS DOUBLE) / count({column}) OVER () END
        AS {column}_freq"""


_C = " OVER (PARTITION BY customer_id)"
_G = " OVER (PARTITION BY category)"
_RFM = f"""CAST(datediff('day', max(invoice_date){_C}, (SELECT max(invoice_date) FROM sales)) + 1 AS BIGINT) AS recency,
    count(invoice_no){_C} AS frequency, {money('total_amount', _C)} AS monetary"""
_CUSTOMER = f"""{mean('total_amount', _C)} AS customer_avg_amount, round(stddev_samp(total_amount){_C}, 2) AS customer_std_amount,
    min(total_amount){_C} AS customer_min_amount, max(total_amount){_C} AS customer_max_amount,
    {mean('quantity', _C)} AS customer_avg_quantity, {money('quantity', _C)} AS customer_total_quantity"""
_CATEGORY = f"""{mean('total_amount', _G)} AS category_avg_amount, {money('total_amount', _G)} AS category_total_amount,
    count(total_amount){_G} AS category_transaction_count, {mean('quantity', _G)} AS category_avg_quantity,
    {money('quantity', _G)} AS category_total_quantity"""
_RANK = """SELECT category, category_total_amount, rank() OVER (ORDER BY category_total_amount DESC)
    + (count(*) OVER (PARTITION BY category_total_amount) - 1) / 2.0 AS category_rank"""
_BY = "OVER (PARTITION BY category, gender)"

ORACLES = {
    "lag_grouped": _lag_sql("PARTITION BY customer_id"),
    "lag_global": _lag_sql(""),
    "rolling_grouped": _rolling_sql("PARTITION BY customer_id"),
    "rolling_global": _rolling_sql(""),
    "date_features": on_sales(f"""SELECT * EXCLUDE (invoice_date, D), D AS invoice_date FROM (SELECT {_O}, {_PARTS}, D FROM
        (SELECT *, CASE WHEN l_orderkey % 31 != 0 THEN invoice_date END AS D FROM sales))"""),
    "encode_label": on_raw(f"""SELECT {_K}, {', '.join(TEXT_COLUMNS)}, quantity, price,
        {', '.join(map(_label, [*TEXT_COLUMNS, 'quantity', 'price']))} FROM raw"""),
    "encode_onehot": on_raw(f"""SELECT {_K}, payment_method, lower(trim(gender)) AS gender,
        CASE WHEN lower(trim(gender)) = 'male' THEN 1 ELSE 0 END AS gender_male,
        """ + ", ".join(
        f"""CASE WHEN payment_method = '{p}' THEN 1 ELSE 0 END AS "payment_method_{p}" """
        for p in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    ) + " FROM raw"),
    "encode_frequency": on_raw(f"SELECT {_K}, category, loyalty_tier, {_freq('category')}, {_freq('loyalty_tier')} FROM raw"),
    "group_aggregates": on_raw(f"""SELECT {_K}, category, gender, price,
        CASE WHEN category IS NOT NULL THEN round(avg(price) {_BY}, 2) END AS price_mean_by_category_gender,
        CASE WHEN category IS NOT NULL THEN round(coalesce(sum(price) {_BY}, 0), 2) END AS price_sum_by_category_gender,
        CASE WHEN category IS NOT NULL THEN round(stddev_samp(price) {_BY}, 2) END AS price_std_by_category_gender,
        CASE WHEN category IS NOT NULL THEN min(price) {_BY} END AS price_min_by_category_gender,
        CASE WHEN category IS NOT NULL THEN max(price) {_BY} END AS price_max_by_category_gender,
        CASE WHEN category IS NOT NULL THEN count(price) {_BY} END AS price_count_by_category_gender FROM raw"""),
    "ratio_feature": on_raw(f"""SELECT {_K}, price, quantity, age, price / quantity AS price_to_quantity_ratio, age % 10 AS decade_rest,
        CASE WHEN age % 10 = 0 THEN 0.0 ELSE CAST(quantity AS DOUBLE) / CAST(age % 10 AS DOUBLE) END AS quantity_per_rest FROM raw"""),
    "rfm_features": on_sales(f"SELECT {_O}, customer_id, invoice_no, total_amount, {_RFM} FROM sales"),
    "customer_stats": on_sales(f"SELECT {_O}, customer_id, invoice_no, total_amount, quantity, {_CUSTOMER} FROM sales"),
    "category_stats": on_sales(f"SELECT {_O}, category, total_amount, quantity, {_CATEGORY} FROM sales"),
    "category_rank": on_sales(f"""{_RANK} FROM (SELECT category, {money('total_amount')} AS category_total_amount FROM sales
        GROUP BY category)"""),
    "price_vs_category": on_raw(f"""SELECT {_K}, category, price, CASE WHEN category IS NULL THEN price / 1.0
        ELSE price / {mean('price', _G)} END AS price_vs_category_avg FROM raw"""),
    "customer_ltv": on_sales(f"SELECT {_O}, customer_id, total_amount, {money('total_amount', _C)} AS customer_ltv FROM sales"),
    "transform_sales": on_sales(f"""SELECT s.*, {_PARTS.replace('(D', '(invoice_date')}, {_RFM}, {_CUSTOMER}, {_CATEGORY},
        r.category_rank, {mean('total_amount', _C)} AS total_amount_mean_by_customer_id,
        {money('total_amount', _C)} AS total_amount_sum_by_customer_id, count(total_amount){_C} AS total_amount_count_by_customer_id,
        {mean('total_amount', _G)} AS total_amount_mean_by_category, {money('total_amount', _G)} AS total_amount_sum_by_category,
        {', '.join(f'lag(total_amount, {n}) OVER (PARTITION BY customer_id ORDER BY {_O}) AS total_amount_lag_{n}' for n in LAGS)},
        {_rolling_columns('PARTITION BY customer_id', ['mean', 'std'])}, {', '.join(map(_label, TEXT_COLUMNS))},
        price / {mean('price', _G)} AS price_vs_category_avg, {money('total_amount', _C)} AS customer_ltv
        FROM (SELECT * FROM sales) s JOIN ({_RANK} FROM (SELECT category AS category, {money('total_amount')} AS category_total_amount
          FROM sales GROUP BY category)) r USING (category)""").replace("CAST(D AS DATE)", "CAST(invoice_date AS DATE)"),
    "transform_without_category": on_sales(f"""SELECT {_O}, customer_id, invoice_no, quantity, price, total_amount,
        {_PARTS.replace('(D', '(invoice_date')}, {_RFM}, {_CUSTOMER}, {mean('total_amount', _C)} AS total_amount_mean_by_customer_id,
        {money('total_amount', _C)} AS total_amount_sum_by_customer_id, count(total_amount){_C} AS total_amount_count_by_customer_id,
        {', '.join(f'lag(total_amount, {n}) OVER (PARTITION BY customer_id ORDER BY {_O}) AS total_amount_lag_{n}' for n in LAGS)},
        {_rolling_columns('PARTITION BY customer_id', ['mean', 'std'])}, {money('total_amount', _C)} AS customer_ltv
        FROM sales""").replace("CAST(D AS DATE)", "CAST(invoice_date AS DATE)"),
    "transform_without_customer": on_sales(f"""SELECT {_O}, s.category, invoice_no, quantity, total_amount,
        {_PARTS.replace('(D', '(invoice_date')}, {_CATEGORY.replace('PARTITION BY category', 'PARTITION BY s.category')}, r.category_rank,
        {mean('total_amount', _G).replace('PARTITION BY category', 'PARTITION BY s.category')} AS total_amount_mean_by_category,
        {money('total_amount', _G).replace('PARTITION BY category', 'PARTITION BY s.category')} AS total_amount_sum_by_category, {_label('s.category').replace('s.category_encoded', 'category_encoded')}
        FROM sales s JOIN ({_RANK} FROM (SELECT category AS category, {money('total_amount')} AS category_total_amount
          FROM sales GROUP BY category)) r ON s.category = r.category""").replace("CAST(D AS DATE)", "CAST(invoice_date AS DATE)"),
}
