"""The registered queries as SQL, written independently of the operators: plain sorts, windows and joins."""

from __future__ import annotations

from checks import sqlmath as M
from marketloom.operators.text import ENGLISH_STOP_WORDS  # a parameter of the query

# Fixed values, stated here again so that a wrong word shows.
QUALITY_WORDS = ("premium", "best", "quality", "certified", "genuine", "authentic")
BUDGET_WORDS = ("cheap", "budget", "economy", "basic", "simple")
CLOUD_STOP_WORDS = tuple(
    "model type new quality best for the and with pro standard grade series version style a an".split()
)

NUMERIC = ("price_min", "price_max", "supplier_rating", "quality_score")

LISTINGS = """
WITH offers AS (
  SELECT l_partkey, l_suppkey,
         min(l_extendedprice / l_quantity * (1 - l_discount)) AS price_min,
         max(l_extendedprice / l_quantity * (1 + l_tax)) AS price_max,
         max(l_shipdate) AS scraped_at
  FROM lineitem GROUP BY l_partkey, l_suppkey
), base AS (
  SELECT l_partkey * 100000 + l_suppkey AS id, p_name AS product_name,
         CASE WHEN p_size % 5 <> 0 THEN concat(p_brand, ' ', p_type, ' ', p_name) END AS description,
         price_min, price_max,
         concat('Rs ', format('{:,}', cast(floor(price_min) AS bigint)),
                ' - Rs ', format('{:,}', cast(floor(price_max) AS bigint))) AS price_raw,
         'unknown' AS price_unit, 'INR' AS currency, s_name AS supplier_name, s_acctbal > 3000 AS supplier_verified,
         greatest(0.0, least(5.0, s_acctbal / 2000)) AS supplier_rating, n_name AS city, r_name AS state,
         'India' AS country, p_type AS category, p_brand AS subcategory,
         concat(lower(p_type), ',', lower(p_brand)) AS tags, 'mock_generated' AS source,
         'mock_generated' AS source_url, scraped_at
  FROM offers JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), scored AS (
  SELECT *, round((cast(length(product_name) > 10 AS int) + 1 + 1 + 1 + cast(description IS NOT NULL AS int) + 1) / 6.0, 2)
         AS quality_score FROM base
), listings AS (SELECT *, quality_score >= 0.7 AS is_complete FROM scored)
"""

SCALED_PRICES = """, sc AS (SELECT id, category, (price_min - avg(price_min) OVER ()) / stddev_pop(price_min) OVER () AS x,
  (price_max - avg(price_max) OVER ()) / stddev_pop(price_max) OVER () AS y FROM listings)
"""
LABELLED = """, labelled AS (
  SELECT *, cast(CASE WHEN price_min > 50000 THEN -1 ELSE least(floor(price_min / 1000), 9) END AS bigint) AS cluster
  FROM listings)
"""

LONG = ", long AS (" + " UNION ALL ".join(
    f"SELECT id, '{c}' AS \"column\", {c} AS value FROM listings WHERE {c} IS NOT NULL" for c in NUMERIC
) + ")"

# Text listings: raw documents in the listing layout.
DOC_RULES = """
WITH d AS (
  SELECT doc_id AS id, text, lang, n_chars,
         length(text) BETWEEN 3 AND 500 AS ok_name, length(text) <= 5000 AS ok_description,
         n_chars >= 0 AS ok_min, n_chars * 2 >= 0 AS ok_max, length(source) <= 300 AS ok_supplier,
         n_chars / 1000.0 BETWEEN 0 AND 5 AS ok_rating, lang IS NOT NULL AS ok_category
  FROM documents
), v AS (
  SELECT *, ok_name AND ok_description AND ok_min AND ok_max AND ok_supplier AND ok_rating AND ok_category AS is_valid FROM d
)
"""

ORACLE: dict[str, str] = {}


def listings(name: str, sql: str, extra: str = "") -> None:
    ORACLE[name] = LISTINGS + extra + sql


def plain(name: str, sql: str) -> None:
    ORACLE[name] = sql


def words(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in values)


# --- sources, ingestion ------------------------------------------------------------------------------------------------

listings(
    "scan_listings",
    """SELECT id, product_name, description, price_min, price_max, price_raw, price_unit, currency, supplier_name,
       supplier_verified, supplier_rating, city, state, country, category, subcategory, tags, source, source_url,
       strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at, quality_score, cast(2 AS int) AS n_tags FROM listings""",
)
listings("listings_by_category", "SELECT id, product_name, category, price_min FROM listings WHERE category = 'PROMO'")
plain(
    "ingest_audit",
    DOC_RULES
    + """SELECT lang AS category, count(*) AS records_collected, count(*) FILTER (is_valid) AS records_validated,
    count(*) FILTER (NOT is_valid) AS records_rejected,
    CASE WHEN count(*) FILTER (is_valid) > 0 THEN 'success' ELSE 'failed' END AS status FROM v GROUP BY lang""",
)
PARSED = "[cast(n AS double) FOR n IN regexp_extract_all(replace(price_raw, ',', ''), '([0-9]+[.]?[0-9]*)', 1)]"
listings(
    "normalize_raw_csv",
    f"""SELECT product_name, list_min({PARSED}) AS price_min, list_max({PARSED}) AS price_max, price_raw, supplier_name,
    city, source_url, strftime(scraped_at, '%Y-%m-%d %H:%M:%S') AS scraped_at FROM listings""",
)


def unescaped(column: str) -> str:
    """The character references that occur in the given pages, also cut off before the semicolon; the ampersand last."""
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        column = f"regexp_replace({column}, '&{name};?', '{char}', 'g')"
    return f"trim({column})"


plain(
    "extract_page_fields",
    rf"""SELECT page_id, {unescaped("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
    {unescaped("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")} AS h1,
    cast(len(regexp_extract_all(regexp_extract(html, '(?s)<nav.*?</nav>'), '<a [^>]*href=')) AS bigint) AS n_links,
    {unescaped("regexp_extract(html, '(?s)<footer[^>]*>(.*?)</footer>', 1)")} AS footer_text FROM pages""",
)
plain("drop_nested", "SELECT vec_id, label FROM embeddings")
listings("union_batches", "SELECT id, category, price_min FROM listings")
listings(
    "append_listings",
    """SELECT category, count(*) AS rows, min(id) AS first_id, max(cast(len(string_split(tags, ',')) AS int)) AS most_tags
    FROM listings GROUP BY category""",
)

# --- fields, validation ----------------------------------------------------------------------------------------------------

plain(
    "clean_name",
    r"""SELECT doc_id, trim(regexp_replace(trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')),
    '[<>{}\[\]\\]', '', 'g')) AS name FROM documents""",
)
listings(
    "parse_price_range",
    f"SELECT id, list_min({PARSED}) AS price_min, list_max({PARSED}) AS price_max FROM listings",
)
plain(
    "validate_listings",
    DOC_RULES
    + """SELECT id, is_valid, concat_ws(',', CASE WHEN NOT ok_name THEN 'product_name' END,
    CASE WHEN NOT ok_description THEN 'description' END, CASE WHEN NOT ok_min THEN 'price_min' END,
    CASE WHEN NOT ok_max THEN 'price_max' END, CASE WHEN NOT ok_supplier THEN 'supplier_name' END,
    CASE WHEN NOT ok_rating THEN 'supplier_rating' END, CASE WHEN NOT ok_category THEN 'category' END) AS reject_reasons
    FROM v""",
)
listings("quality_score", "SELECT id, quality_score FROM listings")
listings("is_complete", "SELECT id, is_complete FROM listings")
listings(
    "category_label",
    """SELECT id, array_to_string([concat(upper(w[1]), w[2:]) FOR w IN
    string_split(replace(lower(concat(category, '-', product_name)), '-', ' '), ' ')], ' ') AS label FROM listings""",
)
listings(
    "coerce_types",
    """SELECT id, price_min, cast(NULL AS double) AS price_max, quality_score, supplier_rating, supplier_verified
    FROM listings""",
)
listings(
    "city_state_lookup",
    "SELECT id, city, CASE WHEN state <> 'ASIA' THEN state ELSE 'Maharashtra' END AS looked_up_state FROM listings",
)
listings(
    "price_label",
    """SELECT supplier_name, CASE WHEN p < 100000 THEN printf('Rs %.0fK', p / 1000) ELSE printf('Rs %.1fL', p / 100000) END
    AS label, CASE WHEN p >= 1000 THEN printf('₹%.1fK', p / 1000) ELSE printf('₹%.0f', p) END AS bar_label
    FROM (SELECT supplier_name, avg(price_min) AS p FROM listings GROUP BY supplier_name)""",
)

# --- lookups -----------------------------------------------------------------------------------------------------------------

listings(
    "frequency_encode",
    """SELECT id, count(*) OVER (PARTITION BY category) AS category_frequency,
    count(*) OVER (PARTITION BY city) AS city_frequency FROM listings""",
)
SEGMENT = """CASE WHEN cluster = -1 THEN 'Noise/Outliers' WHEN avg_price < overall * 0.5 THEN 'Budget'
  WHEN avg_price < overall * 0.8 THEN 'Economy' WHEN avg_price < overall * 1.2 THEN 'Mid-Range'
  WHEN avg_price < overall * 1.8 THEN 'Premium' ELSE 'Enterprise' END"""
SEGMENTS = f""", seg AS (SELECT *, {SEGMENT} AS segment_name FROM (
  SELECT cluster, count(*) AS size, avg(price_min) AS avg_price, (SELECT avg(price_min) FROM listings) AS overall
  FROM labelled GROUP BY cluster))"""
listings(
    "segment_names_join",
    "SELECT id, cluster, segment_name FROM labelled JOIN seg USING (cluster)",
    LABELLED + SEGMENTS,
)
listings(
    "supplier_flag_lookup",
    """SELECT supplier_name, count(*) AS count, arg_min(supplier_verified, id) AS verified FROM listings
    GROUP BY supplier_name ORDER BY count DESC, supplier_name LIMIT 15""",
)

# --- aggregations ------------------------------------------------------------------------------------------------------------

listings(
    "category_stats",
    """SELECT category, count(*) AS count, round(avg(price_min), 2) AS avg_price, min(price_min) AS min_price,
    max(price_max) AS max_price FROM listings GROUP BY category""",
)
listings(
    "category_report",
    """SELECT category, count(product_name) AS count, round(avg(price_min), 4) AS avg_price, min(price_min) AS min_price,
    max(price_min) AS max_of_price_min, round(avg(cast(supplier_verified AS int)), 6) AS verified_share,
    CASE WHEN avg(cast(supplier_verified AS int)) > 0.5 THEN 'success' ELSE 'warning' END AS badge
    FROM listings GROUP BY category""",
)
listings(
    "kpi_summary",
    """SELECT count(*) AS products, count(DISTINCT category) AS categories, count(DISTINCT supplier_name) AS suppliers,
    count(DISTINCT city) AS cities, round(avg(price_min), 4) AS avg_price,
    round(avg(quality_score) * 100, 6) AS avg_quality_pct, printf('Rs %.0fK', avg(price_min) / 1000) AS avg_price_label
    FROM listings""",
)
listings(
    "supplier_profile",
    """SELECT supplier_name, count(*) AS total_listings, round(avg(price_min), 4) AS avg_price,
    string_agg(DISTINCT city, ',' ORDER BY city) AS cities, string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
    bool_or(supplier_verified) AS verified, round(avg(supplier_rating), 6) AS avg_rating
    FROM listings GROUP BY supplier_name""",
)


def top_names(column: str, alias: str) -> str:
    return f""", {alias} AS (SELECT category, string_agg({column}, ',' ORDER BY rn) AS {alias} FROM (
    SELECT category, {column}, row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, {column}) AS rn
    FROM listings GROUP BY category, {column}) WHERE rn <= 5 GROUP BY category)"""


listings(
    "category_profile",
    """SELECT category, count(*) AS total_products, round(avg(price_min), 4) AS avg_price, min(price_min) AS min_price,
    max(price_max) AS max_price, round(stddev_samp(price_min), 4) AS price_std, any_value(top_cities) AS top_cities,
    any_value(top_suppliers) AS top_suppliers
    FROM listings JOIN top_cities USING (category) JOIN top_suppliers USING (category) GROUP BY category""",
    top_names("city", "top_cities") + top_names("supplier_name", "top_suppliers"),
)
listings(
    "analysis_summary",
    """SELECT count(*) AS total_records, count(DISTINCT category) AS categories_analyzed,
    round(avg(price_min), 4) AS overall_avg_price, min(price_min) AS lowest_price, max(price_max) AS highest_price,
    round(avg(quality_score), 6) AS avg_quality_score,
    round(avg(cast(is_complete AS int)) * 100, 6) AS complete_records_pct,
    round(quantile_cont(price_min, 0.5), 6) AS overall_median_price FROM listings""",
)
listings(
    "dataset_profile",
    """SELECT count(*) AS total_records, cast(21 AS bigint) AS total_columns, cast(5 AS bigint) AS numeric_columns,
    cast(13 AS bigint) AS categorical_columns, count(*) FILTER (description IS NULL) AS missing_values,
    round(count(*) FILTER (description IS NULL) * 100 / (count(*) * 21.0), 2) AS missing_percentage,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM listings)) AS duplicate_rows FROM listings""",
)
listings(
    "central_tendency",
    """, r AS (
      SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY "column") AS n,
             row_number() OVER (PARTITION BY "column" ORDER BY id) AS w FROM long
    ), counts AS (SELECT "column", value, count(*) AS c FROM long GROUP BY "column", value),
    modes AS (SELECT "column", value AS mode FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY c DESC, value) AS k
              FROM counts) WHERE k = 1)
    SELECT "column", round(avg(value), 4) AS mean, round(quantile_cont(value, 0.5), 6) AS median,
    any_value(modes.mode) AS mode,
    round(avg(value) FILTER (i >= floor(0.1 * n) AND i < n - floor(0.1 * n)), 4) AS trimmed_mean_10,
    round(avg(value) FILTER (i >= floor(0.2 * n) AND i < n - floor(0.2 * n)), 4) AS trimmed_mean_20,
    CASE WHEN min(value) > 0 THEN round(exp(avg(ln(CASE WHEN value > 0 THEN value END))), 4) END AS geometric_mean,
    CASE WHEN min(value) > 0 THEN round(count(*) / sum(CASE WHEN value > 0 THEN 1 / value END), 4) END AS harmonic_mean,
    round(sum(value * w) / sum(w), 4) AS weighted_mean
    FROM r JOIN modes USING ("column") GROUP BY "column" """,
    LONG,
)
listings(
    "dispersion",
    """, m AS (SELECT "column", quantile_cont(value, 0.5) AS med FROM long GROUP BY "column")
    SELECT "column", round(var_samp(value), 2) AS variance, round(stddev_samp(value), 4) AS std_dev,
    round(stddev_samp(value) / sqrt(count(*)), 6) AS std_error, round(max(value) - min(value), 6) AS range,
    round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr,
    round(quantile_cont(abs(value - med), 0.5), 6) AS mad,
    round(stddev_samp(value) / avg(value) * 100, 4) AS coefficient_of_variation,
    round((quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 2, 6) AS quartile_deviation,
    round((max(value) - min(value)) / avg(value), 6) AS range_to_mean_ratio
    FROM long JOIN m USING ("column") GROUP BY "column" """,
    LONG,
)
MOMENTS = """, mu AS (SELECT "column", avg(value) AS mean, stddev_samp(value) AS sd, count(*)::double AS n FROM long GROUP BY "column"),
moments AS (SELECT "column", any_value(n) AS n, any_value(mean) AS mean, any_value(sd) AS sd,
  avg(power(value - mean, 3)) / power(avg(power(value - mean, 2)), 1.5) AS skew,
  avg(power(value - mean, 4)) / power(avg(power(value - mean, 2)), 2) - 3 AS kurt
  FROM long JOIN mu USING ("column") GROUP BY "column")"""
listings(
    "shape",
    """, q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
    quantile_cont(value, 0.75) AS q3 FROM long GROUP BY "column")
    SELECT "column", round(skew, 6) AS skewness,
    CASE WHEN abs(skew) < 0.5 THEN 'Approximately Symmetric' WHEN skew > 0 THEN 'Right-Skewed (Positive)'
         ELSE 'Left-Skewed (Negative)' END AS skewness_interpretation,
    round(kurt, 5) AS kurtosis,
    CASE WHEN abs(kurt) < 0.5 THEN 'Mesokurtic (Normal-like)' WHEN kurt > 0 THEN 'Leptokurtic (Heavy-tailed)'
         ELSE 'Platykurtic (Light-tailed)' END AS kurtosis_interpretation,
    CASE WHEN q3 <> q1 THEN round((q3 + q1 - 2 * q2) / (q3 - q1), 6) END AS bowley_skewness
    FROM moments JOIN q USING ("column")""",
    LONG + MOMENTS,
)
listings(
    "position",
    'SELECT "column", min(value) AS min, max(value) AS max, '
    + ", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p}" for p in (1, 5, 10, 25, 50, 75, 90, 95, 99))
    + ", "
    + ", ".join(f"round(quantile_cont(value, {d / 10}), 6) AS d{d}" for d in range(1, 10))
    + ' FROM long GROUP BY "column"',
    LONG,
)
listings("value_counts", "SELECT city, count(*) AS count FROM listings GROUP BY city")
listings(
    "crosstab_verified",
    "SELECT category, supplier_verified, count(*) AS count FROM listings GROUP BY category, supplier_verified",
)
listings(
    "category_spread",
    """SELECT category, round(avg(price_max - price_min), 4) AS avg_spread FROM listings GROUP BY category
    ORDER BY avg(price_max - price_min) DESC, category LIMIT 10""",
)
listings(
    "category_volatility",
    """SELECT category, round(stddev_samp(price_min), 4) AS price_std FROM listings GROUP BY category
    ORDER BY stddev_samp(price_min) DESC, category LIMIT 10""",
)
DEEP_DIVE = """SELECT category, count(product_name) AS count, avg(price_min) AS avg_min, stddev_samp(price_min) AS std,
    avg(price_max) AS avg_max, avg(price_max) - avg(price_min) AS range FROM listings GROUP BY category
    ORDER BY count DESC, category LIMIT 10"""
listings(
    "category_deep_dive",
    f"""SELECT category, count, round(avg_min, 4) AS avg_min, round(std, 4) AS std, round(avg_max, 4) AS avg_max,
    round(range, 4) AS range FROM ({DEEP_DIVE})""",
)

# --- ranks, top-k, sets ------------------------------------------------------------------------------------------------------

listings(
    "global_rank",
    """SELECT value, ties, below + (ties + 1) / 2.0 AS avg_rank FROM (
    SELECT price_min AS value, cast(count(*) AS bigint) AS ties, cast(sum(count(*)) OVER (ORDER BY price_min) - count(*) AS double)
    AS below FROM listings GROUP BY price_min)""",
)
listings(
    "price_percentile",
    """SELECT id, category, (rank() OVER (PARTITION BY category ORDER BY price_min)
    + (count(*) OVER (PARTITION BY category, price_min) - 1) / 2.0) / count(*) OVER (PARTITION BY category)
    AS price_percentile FROM listings""",
)
CATEGORY_MEANS = "SELECT category, avg(price_min) AS avg_price FROM listings GROUP BY category"
listings(
    "category_price_rank",
    f"""SELECT category, round(avg_price, 4) AS avg_price, cast(rank() OVER (ORDER BY avg_price) AS double)
    AS category_price_rank FROM ({CATEGORY_MEANS})""",
)
listings(
    "price_waterfall",
    f"""SELECT category, round(avg_price, 4) AS avg_price, round(step, 4) AS step,
    round(sum(step) OVER (ORDER BY avg_price DESC, category), 4) AS running_total FROM (
    SELECT *, avg_price - min(avg_price) OVER () AS step FROM ({CATEGORY_MEANS} ORDER BY avg_price DESC, category LIMIT 8))""",
)
listings(
    "topk_by_count", "SELECT city, count(*) AS count FROM listings GROUP BY city ORDER BY count DESC, city LIMIT 15"
)
listings(
    "topk_by_mean",
    """SELECT city, round(avg(price_min), 4) AS avg_price FROM listings GROUP BY city
    ORDER BY avg(price_min) DESC, city LIMIT 15""",
)


def top_per_cluster(column: str) -> str:
    return f"""SELECT cluster, {column} AS item, n, rank FROM (SELECT cluster, {column}, count(*) AS n,
    cast(row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, {column}) AS int) AS rank
    FROM labelled GROUP BY cluster, {column}) WHERE rank <= 3"""


listings(
    "topk_per_group",
    f"SELECT cluster, item, n AS count, rank FROM ({top_per_cluster('category')})",
    LABELLED,
)
plain(
    "dedup_count",
    """SELECT cast(sum(c) AS bigint) AS rows, count(*) AS distinct_rows, cast(sum(c - 1) AS bigint) AS duplicate_rows
    FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang)""",
)

# --- distributions -------------------------------------------------------------------------------------------------------------

plain(
    "normality_shapiro",
    f"""WITH s AS (SELECT s_acctbal AS x, row_number() OVER (ORDER BY s_acctbal) AS i, count(*) OVER () AS n FROM supplier
    WHERE s_acctbal IS NOT NULL), m AS (SELECT *, {M.ppf('((i - 0.375) / (n + 0.25))')} AS m FROM s),
    t AS (SELECT sum(m * m) AS mm, max(m) AS last, max(m) FILTER (i = n - 1) AS next, any_value(n) AS n, 1 / sqrt(any_value(n))
      AS u, avg(x) AS mean FROM m),
    e AS (SELECT *, {M.poly('u', (-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0))} + last / sqrt(mm) AS a1,
      {M.poly('u', (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0))} + next / sqrt(mm) AS a2 FROM t),
    f AS (SELECT *, sqrt((mm - 2 * last * last - 2 * next * next) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS scale FROM e)
    SELECT 's_acctbal' AS "column", 'shapiro_wilk' AS test, round(power(sum(x * CASE WHEN i = 1 THEN -a1 WHEN i = 2 THEN -a2
      WHEN i = f.n THEN a1 WHEN i = f.n - 1 THEN a2 ELSE m / scale END), 2) / sum((x - mean) * (x - mean)), 6) AS statistic
    FROM m, f WHERE f.n BETWEEN 8 AND 5000 HAVING count(*) > 0""",
)
DAGOSTINO = """, ds AS (SELECT *, skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
  (kurt + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS b FROM moments),
da AS (SELECT *, y / sqrt(2 / (w2 - 1)) AS r, 6 + 8 / b * (2 / b + sqrt(1 + 4 / (b * b))) AS a FROM ds),
dz AS (SELECT *, ln(r + sqrt(r * r + 1)) / sqrt(0.5 * ln(w2)) AS zs, 1 + x * sqrt(2 / (a - 4)) AS g FROM da),
dag AS (SELECT "column", zs * zs + power((1 - 2 / (9 * a) - sign(g) * power((1 - 2 / a) / abs(g), 1.0 / 3)) / sqrt(2 / (9 * a)), 2)
  AS k2 FROM dz)"""
listings(
    "normality_dagostino",
    """SELECT "column", 'dagostino_pearson' AS test, round(k2, 2) AS statistic, round(exp(-k2 / 2), 6) AS p_value,
    exp(-k2 / 2) > 0.05 AS is_normal FROM dag""",
    LONG + MOMENTS + DAGOSTINO,
)
JB = "(n / 6 * (skew * skew + kurt * kurt / 4))"
listings(
    "normality_jarque_bera",
    f"""SELECT "column", 'jarque_bera' AS test, round({JB}, 2) AS statistic, round(exp(-{JB} / 2), 6) AS p_value,
    exp(-{JB} / 2) > 0.05 AS is_normal FROM moments""",
    LONG + MOMENTS,
)
SORTED = """, z AS (SELECT "column", (value - mean) / sd AS z, n,
  row_number() OVER (PARTITION BY "column" ORDER BY value)::double AS i FROM long JOIN mu USING ("column"))"""
KS = f""", ks AS (SELECT "column", max(greatest({M.cdf('z')} - (i - 1) / n, i / n - {M.cdf('z')})) AS d, any_value(n) AS n
  FROM z GROUP BY "column")"""
AD = f""", ad AS (SELECT "column", -any_value(n) - sum((2 * i - 1) * ln({M.cdf('z')}) + (2 * (n - i) + 1) * ln({M.sf('z')}))
  / any_value(n) AS a2, any_value(n) AS n FROM z GROUP BY "column")"""
AD_NORMAL = "a2 < round(0.787 / (1 + 4 / n - 25 / (n * n)), 3)"
listings(
    "normality_ks",
    f"""SELECT "column", 'kolmogorov_smirnov' AS test, round(d, 6) AS statistic, round({M.kolmogorov_sf('d', 'n')}, 6) AS p_value,
    {M.kolmogorov_sf('d', 'n')} > 0.05 AS is_normal FROM ks""",
    LONG + MOMENTS + SORTED + KS,
)
plain(
    "normality_ks_exact",
    f"""WITH RECURSIVE z AS (SELECT (s_acctbal - avg(s_acctbal) OVER ()) / stddev_samp(s_acctbal) OVER () AS z,
      row_number() OVER (ORDER BY s_acctbal)::double AS i, count(*) OVER () AS n FROM supplier),
    ks AS (SELECT max(greatest({M.cdf('z')} - (i - 1) / n, i / n - {M.cdf('z')})) AS d, any_value(n) AS n FROM z),
    {M.kolmogorov_exact('ks')}
    SELECT 's_acctbal' AS "column", 'kolmogorov_smirnov' AS test, round(d, 6) AS statistic, round(p_value, 6) AS p_value,
    p_value > 0.05 AS is_normal FROM ks, kolmogorov""",
)
listings(
    "normality_anderson",
    f"""SELECT "column", 'anderson_darling' AS test, round(a2, 2) AS statistic, {AD_NORMAL} AS is_normal FROM ad""",
    LONG + MOMENTS + SORTED + AD,
)
# More than 5000 rows: four tests run. The Kolmogorov distance is compared with the 5 % point of its limit.
listings(
    "normality_verdict",
    f"""SELECT "column", tests_passed, cast(4 AS bigint) AS total_tests, tests_passed >= 2 AS is_likely_normal FROM (
    SELECT "column", cast(k2 < -2 * ln(0.05) AS bigint) + cast({JB} < -2 * ln(0.05) AS bigint)
    + cast((sqrt(ks.n) + 0.12 + 0.11 / sqrt(ks.n)) * d < 1.358098 AS bigint)
    + cast(a2 < round(0.787 / (1 + 4 / ad.n - 25 / (ad.n * ad.n)), 3) AS bigint) AS tests_passed
    FROM dag JOIN (SELECT "column", n, skew, kurt FROM moments) USING ("column") JOIN (SELECT "column", d, n FROM ks) ks USING ("column")
    JOIN ad USING ("column") WHERE "column" IN ('price_min', 'price_max'))""".replace(
        "n / 6", "moments_n / 6"
    ).replace('SELECT "column", n, skew, kurt FROM moments', 'SELECT "column", n AS moments_n, skew, kurt FROM moments'),
    LONG + MOMENTS + DAGOSTINO + SORTED + KS + AD,
)
listings(
    "fit_distributions",
    f"""
    , p AS (SELECT avg(price_min) AS mean, stddev_pop(price_min) AS sd, min(price_min) AS low, avg(ln(price_min)) AS ml,
            stddev_pop(ln(price_min)) AS sl, count(*)::double AS n FROM listings),
    r AS (SELECT price_min AS x, row_number() OVER (ORDER BY price_min)::double AS i, p.* FROM listings, p),
    f AS (
      SELECT 'norm' AS distribution, sum(-power((x - mean) / sd, 2) / 2 - ln(sd) - 0.5 * ln(2 * pi())) AS ll, any_value(n) AS n,
        max(greatest({M.cdf('((x - mean) / sd)')} - (i - 1) / n, i / n - {M.cdf('((x - mean) / sd)')})) AS ks FROM r
      UNION ALL SELECT 'lognorm', sum(-power((ln(x) - ml) / sl, 2) / 2 - ln(x) - ln(sl) - 0.5 * ln(2 * pi())), any_value(n),
        max(greatest({M.cdf('((ln(x) - ml) / sl)')} - (i - 1) / n, i / n - {M.cdf('((ln(x) - ml) / sl)')})) FROM r
      UNION ALL SELECT 'expon', sum(-(x - low) / (mean - low) - ln(mean - low)), any_value(n),
        max(greatest(1 - exp(-(x - low) / (mean - low)) - (i - 1) / n, i / n - 1 + exp(-(x - low) / (mean - low)))) FROM r)
    SELECT distribution, cast(2 AS int) AS n_params, round(ll, 2) AS log_likelihood, round(4 - 2 * ll, 2) AS aic,
    round(2 * ln(n) - 2 * ll, 2) AS bic, round(ks, 6) AS ks_statistic, ll = max(ll) OVER () AS is_best FROM f""",
)
listings(
    "qq_correlation",
    f"""SELECT "column", round(corr(q, value), 6) AS qq_correlation, corr(q, value) > 0.95 AS is_approximately_normal
    FROM (SELECT "column", value, {M.ppf('p')} AS q FROM (SELECT "column", value, 0.01 + 0.98 *
      (row_number() OVER (PARTITION BY "column" ORDER BY value) - 1) / (count(*) OVER (PARTITION BY "column") - 1) AS p FROM long))
    GROUP BY "column" """,
    LONG,
)

# --- correlation ---------------------------------------------------------------------------------------------------------------


def pairs(select: str, source: str = "listings", columns: tuple[str, ...] = NUMERIC, which=lambda i, j: True) -> str:
    """UNION ALL over column pairs; {a} and {b} name the columns, {i} and {j} their places."""
    return " UNION ALL ".join(
        select.format(a=a, b=b, i=i, j=j) + f" FROM {source}"
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if which(i, j)
    )


listings(
    "pearson_matrix",
    f"SELECT column_a, column_b, n, round(r, 6) AS r, round({M.correlation_p('r', 'n')}, 6) AS p_value FROM ("
    + pairs("SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, corr({a}, {b}) AS r")
    + ")",
)
RANKED = ", ranked AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in NUMERIC
) + " FROM listings)"
listings(
    "spearman_matrix",
    pairs("SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS rho", "ranked"),
    RANKED,
)
listings(
    "kendall_matrix",
    """, cells AS (SELECT supplier_rating AS x, quality_score AS y, count(*)::double AS w FROM listings GROUP BY 1, 2),
    s AS (SELECT sum(a.w * b.w * sign(a.x - b.x) * sign(a.y - b.y)) / 2 AS s FROM cells a, cells b),
    t AS (SELECT sum(w) * (sum(w) - 1) / 2 AS p FROM cells),
    tx AS (SELECT sum(w * (w - 1) / 2) AS t FROM (SELECT sum(w) AS w FROM cells GROUP BY x)),
    ty AS (SELECT sum(w * (w - 1) / 2) AS t FROM (SELECT sum(w) AS w FROM cells GROUP BY y))
    SELECT 'supplier_rating' AS column_a, 'quality_score' AS column_b,
    round(s / sqrt((p - tx.t) * (p - ty.t)), 6) AS tau FROM s, t, tx, ty""",
)


listings(
    "kendall_sampled",
    "SELECT column_a, column_b, CASE WHEN room > 0 THEN round(s / sqrt(room), 6) END AS tau FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b, sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b})) AS s,
        sum(cast(p.{a} <> q.{a} AS int))::double * sum(cast(p.{b} <> q.{b} AS int)) AS room
        FROM drawn p, drawn q WHERE p.{a} IS NOT NULL AND p.{b} IS NOT NULL AND q.{a} IS NOT NULL AND q.{b} IS NOT NULL"""
        for a in NUMERIC
        for b in NUMERIC
    )
    + ")",
    ", drawn AS (SELECT * FROM listings ORDER BY md5(cast(id AS varchar)), id LIMIT 1000)",
)
plain(
    "kendall_customers",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b}))
        / sqrt(sum(cast(p.{a} <> q.{a} AS int))::double * sum(cast(p.{b} <> q.{b} AS int))), 9) AS tau FROM customer p, customer q"""
        for a, b in (("c_acctbal", "c_nationkey"), ("c_acctbal", "c_custkey"), ("c_nationkey", "c_custkey"))
    ),
)
listings("sample_rows", "SELECT id, price_min, price_max FROM listings ORDER BY md5(cast(id AS varchar)), id LIMIT 1000")
listings(
    "price_scatter",
    """, drawn AS (SELECT id, price_min, price_max FROM listings WHERE price_min IS NOT NULL AND price_max IS NOT NULL
      ORDER BY md5(cast(id AS varchar)), id LIMIT 600)
    SELECT id, price_min, price_max, (SELECT max(greatest(price_min, price_max)) FROM drawn) AS reference_max FROM drawn""",
)
listings(
    "csv_round_trip",
    """SELECT category, count(*) * CASE WHEN category = 'PROMO' THEN 2 ELSE 1 END AS rows,
    count(description) * CASE WHEN category = 'PROMO' THEN 2 ELSE 1 END AS described, min(product_name) AS first_name,
    round(sum(price_min) * CASE WHEN category = 'PROMO' THEN 2 ELSE 1 END, 2) AS total_min
    FROM listings GROUP BY category""",
)


def partial(a: str, b: str, given: list[str]) -> str:
    """Recursive partial correlation from plain ones."""
    if not given:
        return f"corr({a}, {b})"
    c, rest = given[-1], given[:-1]
    ab, ac, bc = partial(a, b, rest), partial(a, c, rest), partial(b, c, rest)
    return f"(({ab} - {ac} * {bc}) / sqrt((1 - {ac} * {ac}) * (1 - {bc} * {bc})))"


listings(
    "partial_correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        f"round({partial(a, b, [c for c in NUMERIC if c not in (a, b)])}, 6) AS partial_r FROM listings"
        for i, a in enumerate(NUMERIC)
        for b in NUMERIC[i + 1 :]
    ),
)
listings(
    "strong_correlations",
    "SELECT column_a, column_b, round(r, 6) AS r, CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction FROM ("
    + pairs("SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS r", which=lambda i, j: i < j)
    + ") WHERE abs(r) > 0.7",
)
listings(
    "correlation_heatmap",
    pairs("SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 2) AS r, {i} >= {j} AS in_lower"),
)

# --- tests across groups ---------------------------------------------------------------------------------------------------------


def variance_parts(source: str, value: str) -> str:
    return f""", g AS (SELECT category, count(*)::double AS n, avg({value}) AS mean, var_samp({value}) AS var FROM {source}
    GROUP BY category HAVING count(*) >= 2), gm AS (SELECT sum(n * mean) / sum(n) AS grand FROM g),
    ss AS (SELECT count(*)::double AS k, sum(n) AS n, sum(n * power(mean - grand, 2)) AS b, sum((n - 1) * var) AS w FROM g, gm)"""


listings(
    "anova",
    f"""SELECT round(f, 4) AS f_statistic, round(p, 6) AS p_value, p < 0.05 AS is_significant, round(b / (b + w), 8) AS eta_squared,
    round((b - (k - 1) * w / (n - k)) / (b + w + w / (n - k)), 8) AS omega_squared,
    CASE WHEN b / (b + w) > 0.14 THEN 'Large' WHEN b / (b + w) > 0.06 THEN 'Medium' ELSE 'Small' END
    AS effect_size_interpretation
    FROM (SELECT *, {M.f_sf('f', '(k - 1)', '(n - k)')} AS p FROM (SELECT *, (b / (k - 1)) / (w / (n - k)) AS f FROM ss))""",
    variance_parts("listings", "price_min"),
)
PRICE_RANKS = """, pr AS (SELECT category, price_min, rank() OVER (ORDER BY price_min)
  + (count(*) OVER (PARTITION BY price_min) - 1) / 2.0 AS r, count(*) OVER ()::double AS n FROM listings)"""
listings(
    "kruskal",
    f"""SELECT round(h, 4) AS h_statistic, round(p, 6) AS p_value, p < 0.05 AS is_significant FROM (
    SELECT h, {M.chi2_sf('h', '(k - 1)')} AS p FROM (
    SELECT k, (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - t / (n * n * n - n)) AS h FROM
    (SELECT sum(rs * rs / c) AS s, any_value(n) AS n, count(*) AS k FROM (SELECT category, sum(r) AS rs, count(*) AS c, any_value(n) AS n
      FROM pr GROUP BY category)),
    (SELECT sum(c * c * c - c) AS t FROM (SELECT count(*)::double AS c FROM listings GROUP BY price_min))))""",
    PRICE_RANKS,
)
# Ranks of each pair of groups pooled on their own.
listings(
    "mann_whitney_pairs",
    f""", cats AS (SELECT DISTINCT category FROM listings),
    pooled AS (SELECT a.category AS ga, b.category AS gb, l.category, l.price_min FROM cats a JOIN cats b ON a.category < b.category
      JOIN listings l ON l.category = a.category OR l.category = b.category),
    rk AS (SELECT *, rank() OVER (PARTITION BY ga, gb ORDER BY price_min)
      + (count(*) OVER (PARTITION BY ga, gb, price_min) - 1) / 2.0 AS r,
      count(*) OVER (PARTITION BY ga, gb, price_min)::double AS t FROM pooled),
    u AS (SELECT ga, gb, sum(r) FILTER (category = ga) - n1 * (n1 + 1) / 2 AS u, n1, n2, ties FROM (
      SELECT *, count(*) FILTER (category = ga) OVER (PARTITION BY ga, gb)::double AS n1,
      count(*) FILTER (category = gb) OVER (PARTITION BY ga, gb)::double AS n2,
      sum(t * t - 1) OVER (PARTITION BY ga, gb) AS ties FROM rk) GROUP BY ga, gb, n1, n2, ties),
    z AS (SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5)
      / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u)
    SELECT ga AS group_a, gb AS group_b, u AS u_statistic, round(least(1.0, 2 * {M.sf('z')}), 6) AS p_value FROM z""",
)
# Groups of a few untied rows: every arrangement counted, rank by rank.
plain(
    "mann_whitney_small",
    """WITH RECURSIVE g AS (SELECT concat(s_nationkey, '') AS grp, s_acctbal AS x FROM supplier),
    sizes AS (SELECT grp, count(*) AS n FROM g GROUP BY grp HAVING count(*) >= 2),
    u AS (SELECT a.grp AS ga, b.grp AS gb, sum((a.x > b.x)::int + 0.5 * (a.x = b.x)::int) AS u, any_value(p.n) AS n1, any_value(q.n) AS n2
      FROM g a JOIN g b ON a.grp < b.grp JOIN sizes p ON p.grp = a.grp JOIN sizes q ON q.grp = b.grp GROUP BY 1, 2),
    kinds AS (SELECT DISTINCT n1, n2 FROM u),
    ways AS (SELECT n1, n2, 0 AS rank, 0 AS taken, 0 AS total, 1::hugeint AS c FROM kinds
      UNION ALL SELECT n1, n2, rank + 1, taken + d, total + d * (rank + 1), sum(c)::hugeint FROM ways, (VALUES (0), (1)) AS t(d)
        WHERE rank < n1 + n2 AND taken + d <= n1 AND n1 + n2 - rank - 1 >= n1 - taken - d GROUP BY ALL),
    law AS (SELECT n1, n2, total - n1 * (n1 + 1) / 2 AS u, c, sum(c) OVER (PARTITION BY n1, n2) AS whole FROM ways WHERE rank = n1 + n2)
    SELECT ga AS group_a, gb AS group_b, any_value(u.u)::double AS u_statistic,
    round(least(1.0, 2 * sum(c) FILTER (law.u >= greatest(u.u, u.n1 * u.n2 - u.u)) / any_value(whole)), 6) AS p_value
    FROM u JOIN law USING (n1, n2) GROUP BY ga, gb""",
)
DEVIATIONS = """, med AS (SELECT category, quantile_cont(price_min, 0.5) AS m FROM listings GROUP BY category),
  dv AS (SELECT category, abs(price_min - m) AS d FROM listings JOIN med USING (category))"""
listings(
    "levene",
    f"""SELECT round(f, 4) AS statistic, round(p, 6) AS p_value, p > 0.05 AS equal_variances FROM (
    SELECT f, {M.f_sf('f', '(k - 1)', '(n - k)')} AS p FROM (SELECT *, (b / (k - 1)) / (w / (n - k)) AS f FROM ss))""",
    DEVIATIONS + variance_parts("dv", "d"),
)
listings(
    "bartlett",
    f"""SELECT round(x, 4) AS statistic, round(pv, 6) AS p_value, pv > 0.05 AS equal_variances FROM (
    SELECT x, {M.chi2_sf('x', '(k - 1)')} AS pv FROM (
    SELECT k, (f * ln(p) - l) / (1 + (i - 1 / f) / (3 * (k - 1))) AS x FROM (
    SELECT count(*) AS k, sum(n - 1) AS f, sum((n - 1) * var) / sum(n - 1) AS p, sum((n - 1) * ln(var)) AS l,
    sum(1 / (n - 1)) AS i FROM g)))""",
    variance_parts("listings", "price_min"),
)
listings(
    "fligner",
    f""", fr AS (SELECT category, (rank() OVER (ORDER BY d) + (count(*) OVER (PARTITION BY d) - 1) / 2.0) AS r,
    count(*) OVER () AS n FROM dv), fs AS (SELECT category, {M.ppf('(0.5 + r / (2.0 * (n + 1)))')} AS a FROM fr),
    fm AS (SELECT avg(a) AS grand, var_samp(a) AS v FROM fs),
    fg AS (SELECT category, count(*) AS n, avg(a) AS mean FROM fs GROUP BY category)
    SELECT round(x, 4) AS statistic, round(p, 6) AS p_value, p > 0.05 AS equal_variances FROM (
    SELECT x, {M.chi2_sf('x', '(k - 1)')} AS p FROM (
    SELECT sum(n * power(mean - grand, 2)) / any_value(v) AS x, count(*) AS k FROM fg, fm))""",
    DEVIATIONS,
)
listings(
    "chi_square",
    f""", o AS (SELECT c.category AS a, v.supplier_verified AS b, (SELECT count(*) FROM listings l WHERE l.category = c.category
      AND l.supplier_verified = v.supplier_verified)::double AS o FROM (SELECT DISTINCT category FROM listings) c,
      (SELECT DISTINCT supplier_verified FROM listings) v),
    e AS (SELECT *, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e FROM o),
    x AS (SELECT sum(power(o - e, 2) / e) AS chi2, sum(o) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS c FROM e)
    SELECT round(chi2, 6) AS chi2_statistic, round({M.chi2_sf('chi2', '((r - 1) * (c - 1))')}, 6) AS p_value,
    {M.chi2_sf('chi2', '((r - 1) * (c - 1))')} < 0.05 AS is_significant, cast((r - 1) * (c - 1) AS bigint) AS degrees_of_freedom,
    round(sqrt(chi2 / (n * (least(r, c) - 1))), 8) AS cramers_v,
    CASE WHEN sqrt(chi2 / (n * (least(r, c) - 1))) > 0.5 THEN 'Large' WHEN sqrt(chi2 / (n * (least(r, c) - 1))) > 0.3
      THEN 'Medium' ELSE 'Small' END AS effect_size_interpretation FROM x""",
)

# --- outliers --------------------------------------------------------------------------------------------------------------------

FENCES = """, q AS (SELECT quantile_cont(price_min, 0.25) AS q1, quantile_cont(price_min, 0.75) AS q3 FROM listings),
  fence AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi,
    q1 - 3 * (q3 - q1) AS xlo, q3 + 3 * (q3 - q1) AS xhi FROM q),
  zs AS (SELECT avg(price_min) AS mean, stddev_pop(price_min) AS sd FROM listings),
  md AS (SELECT quantile_cont(price_min, 0.5) AS med FROM listings),
  mad AS (SELECT any_value(med) AS med, quantile_cont(abs(price_min - med), 0.5) AS mad FROM listings, md)"""
listings(
    "outliers_iqr",
    """SELECT round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3, round(any_value(iqr), 6) AS iqr,
    round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound,
    count(*) FILTER (price_min < lo OR price_min > hi) AS outlier_count,
    round(count(*) FILTER (price_min < lo OR price_min > hi) * 100 / count(*), 6) AS outlier_percentage,
    count(*) FILTER (price_min < xlo OR price_min > xhi) AS extreme_outlier_count FROM listings, fence""",
    FENCES,
)
listings(
    "outliers_zscore",
    """SELECT count(*) FILTER (abs(price_min - mean) / sd > 2) AS outliers_2sigma,
    count(*) FILTER (abs(price_min - mean) / sd > 3) AS outliers_3sigma,
    round(count(*) FILTER (abs(price_min - mean) / sd > 2) * 100 / count(*), 6) AS percentage_2sigma,
    round(count(*) FILTER (abs(price_min - mean) / sd > 3) * 100 / count(*), 6) AS percentage_3sigma FROM listings, zs""",
    FENCES,
)
MAD_OUT = "abs(0.6745 * (price_min - med) / mad) > 3.5"
listings(
    "outliers_mad",
    f"""SELECT round(any_value(med), 6) AS median, round(any_value(mad), 6) AS mad, count(*) FILTER ({MAD_OUT}) AS outlier_count,
    round(count(*) FILTER ({MAD_OUT}) * 100 / count(*), 6) AS outlier_percentage FROM listings, mad""",
    FENCES,
)
listings(
    "outlier_comparison",
    f"""SELECT cast(2 AS bigint) AS methods, (a + b) / 2 AS average_outliers, greatest(a, b) AS max_outliers,
    least(a, b) AS min_outliers FROM (SELECT count(*) FILTER (price_min < lo OR price_min > hi) AS a,
    count(*) FILTER ({MAD_OUT}) AS b FROM listings, fence, mad)""",
    FENCES,
)
listings(
    "anomaly_flags",
    f"""SELECT id, price_min < lo OR price_min > hi AS is_iqr_outlier, abs(price_min - mean) / sd > 3 AS is_zscore_outlier,
    {MAD_OUT} AS is_mad_outlier FROM listings, fence, zs, mad""",
    FENCES,
)

# --- features, clustering ----------------------------------------------------------------------------------------------------------

listings(
    "engineer_features",
    f""", cr AS (SELECT category, cast(rank() OVER (ORDER BY avg_price) AS double) AS category_price_rank FROM ({CATEGORY_MEANS}))
    SELECT id, price_min, price_max, price_max - price_min AS price_range, (price_min + price_max) / 2 AS price_mid,
    round(ln(1 + price_min), 8) AS log_price_min, round(ln(1 + price_max), 8) AS log_price_max,
    price_max / (price_min + 1) AS price_ratio,
    (price_max - price_min) / ((price_min + price_max) / 2 + 1) AS price_volatility,
    count(*) OVER (PARTITION BY category) AS category_frequency, category_price_rank,
    count(*) OVER (PARTITION BY city) AS city_frequency, cast(supplier_verified AS int) AS verified_int
    FROM listings JOIN cr USING (category)""",
)
listings(
    "impute_median",
    """, gap AS (SELECT id, CASE WHEN supplier_rating > 0 THEN price_min END AS a,
      CASE WHEN description IS NOT NULL THEN price_max END AS b FROM listings),
    m AS (SELECT quantile_cont(a, 0.5) AS ma, quantile_cont(b, 0.5) AS mb FROM gap)
    SELECT id, coalesce(a, ma) AS price_min, coalesce(b, mb) AS price_max FROM gap, m""",
)


def scaled(method: str, shift: str, width: str) -> str:
    parts = [f"round(({c} - {shift.format(c=c)}) / ({width.format(c=c)}), 6) AS {c}" for c in ("price_min", "supplier_rating")]
    return f"SELECT id, '{method}' AS method, {', '.join(parts)} FROM listings, sc"


SCALES = ", sc AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_avg, stddev_pop({c}) AS {c}_sd, min({c}) AS {c}_lo, max({c}) AS {c}_hi, "
    f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.5) AS {c}_q2, quantile_cont({c}, 0.75) AS {c}_q3"
    for c in ("price_min", "supplier_rating")
) + " FROM listings)"
listings(
    "scale_features",
    " UNION ALL ".join(
        [
            scaled("standard", "{c}_avg", "{c}_sd"),
            scaled("minmax", "{c}_lo", "{c}_hi - {c}_lo"),
            scaled("robust", "{c}_q2", "{c}_q3 - {c}_q1"),
        ]
    ),
    SCALES,
)
listings(
    "cluster_metrics",
    """, c AS (SELECT cluster, count(*)::double AS n, avg(price_min) AS x, avg(price_max) AS y,
      avg(price_min * price_min + price_max * price_max) AS nn FROM labelled GROUP BY cluster),
    own AS (SELECT l.cluster, sqrt(power(price_min - x, 2) + power(price_max - y, 2)) AS d,
      power(price_min - x, 2) + power(price_max - y, 2) AS d2 FROM labelled l JOIN c USING (cluster)),
    s AS (SELECT cluster, avg(d) AS s, sum(d2) AS sse FROM own GROUP BY cluster),
    g AS (SELECT sum(n * x) / sum(n) AS gx, sum(n * y) / sum(n) AS gy, sum(n) AS n, count(*) AS k FROM c),
    b AS (SELECT sum(c.n * (power(x - gx, 2) + power(y - gy, 2))) AS b FROM c, g),
    w AS (SELECT sum(sse) AS w FROM s),
    r AS (SELECT a.cluster, max((sa.s + sb.s) / sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))) AS r FROM c a
      JOIN c b ON a.cluster <> b.cluster JOIN s sa ON sa.cluster = a.cluster JOIN s sb ON sb.cluster = b.cluster GROUP BY a.cluster),
    far AS (SELECT l.id, l.cluster, c.cluster AS other, c.n, greatest(0, l.price_min * l.price_min + l.price_max * l.price_max + c.nn
      - 2 * (l.price_min * c.x + l.price_max * c.y)) AS m FROM labelled l, c),
    ab AS (SELECT id, max(m * n / greatest(n - 1, 1)) FILTER (cluster = other) AS a, min(m) FILTER (cluster <> other) AS b,
      max(n) FILTER (cluster = other) AS own FROM far GROUP BY id),
    sil AS (SELECT avg(CASE WHEN own = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS sil FROM ab)
    SELECT k AS n_clusters, round(w / 1e6, 2) AS inertia, round(sil, 6) AS silhouette,
    round(b.b / (k - 1) / (w / (g.n - k)), 3) AS calinski_harabasz,
    round((SELECT avg(r) FROM r), 6) AS davies_bouldin FROM g, b, w, sil""",
    LABELLED,
)
listings(
    "pca",
    """SELECT cast(component AS int) AS component, round(v, 6) AS explained_variance, round(t, 6) AS cumulative_variance,
    cast(CASE WHEN (1 + r) / 2 >= 0.95 THEN 1 ELSE 2 END AS int) AS components_for_95_pct FROM (
    SELECT 1 AS component, (1 + r) / 2 AS v, (1 + r) / 2 AS t, r FROM rr UNION ALL SELECT 2, (1 - r) / 2, 1.0, r FROM rr)""",
    ", rr AS (SELECT abs(corr(price_min, price_max)) AS r FROM listings)",
)
listings(
    "cluster_profile_numeric",
    """, rows AS (SELECT *, price_max - price_min AS price_range FROM labelled),
    l AS (SELECT cluster, 'price_min' AS "column", price_min AS value FROM rows UNION ALL
          SELECT cluster, 'price_max', price_max FROM rows UNION ALL SELECT cluster, 'price_range', price_range FROM rows)
    SELECT cluster, "column", round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min,
    max(value) AS max, round(quantile_cont(value, 0.5), 6) AS median, count(*) AS size,
    round(count(*) * 100 / (SELECT count(*) FROM listings), 6) AS percentage
    FROM l WHERE cluster <> -1 GROUP BY cluster, "column" """,
    LABELLED,
)
listings(
    "cluster_profile_categorical",
    f"""SELECT cluster, item, n, rank, attribute, verified_percentage FROM (
    SELECT *, 'category' AS attribute FROM ({top_per_cluster('category')}) UNION ALL
    SELECT *, 'city' AS attribute FROM ({top_per_cluster('city')}))
    JOIN (SELECT cluster, round(avg(cast(supplier_verified AS int)) * 100, 6) AS verified_percentage FROM labelled
          GROUP BY cluster) USING (cluster) WHERE cluster <> -1""",
    LABELLED,
)
listings(
    "segment_names",
    "SELECT cluster, size, round(avg_price, 4) AS avg_price, segment_name FROM seg",
    LABELLED + SEGMENTS,
)

# On a line, clusters are runs of core points without a gap beyond eps.
plain(
    "dbscan_balances",
    """WITH p AS (SELECT c_custkey AS id, c_acctbal AS x, count(*) OVER (ORDER BY c_acctbal
      RANGE BETWEEN 5.005 PRECEDING AND 5.005 FOLLOWING) AS n FROM customer),
    core AS (SELECT id, x, CASE WHEN x - lag(x) OVER (ORDER BY x, id) <= 5.005 THEN 0 ELSE 1 END AS starts FROM p WHERE n >= 5),
    runs AS (SELECT id, x, sum(starts) OVER (ORDER BY x, id ROWS UNBOUNDED PRECEDING) AS g FROM core),
    num AS (SELECT g, row_number() OVER (ORDER BY min(id)) - 1 AS label FROM runs GROUP BY g),
    lab AS (SELECT id, x, label FROM runs JOIN num USING (g)),
    near AS (SELECT p.id, min(label) AS label FROM p JOIN lab ON lab.x BETWEEN p.x - 5.005 AND p.x + 5.005 GROUP BY p.id)
    SELECT p.id, cast(coalesce(lab.label, near.label, -1) AS bigint) AS dbscan_cluster,
    coalesce(lab.label, near.label) IS NULL AS is_anomaly
    FROM p LEFT JOIN lab ON lab.id = p.id LEFT JOIN near ON near.id = p.id""",
)
plain(
    "kdistance_balances",
    """WITH d AS (SELECT a.s_suppkey AS i, abs(a.s_acctbal - b.s_acctbal) AS d,
      row_number() OVER (PARTITION BY a.s_suppkey ORDER BY abs(a.s_acctbal - b.s_acctbal)) AS k FROM supplier a, supplier b),
    s AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS place, lead(d) OVER (ORDER BY d) - d AS jump FROM d WHERE k = 5)
    SELECT cast(5 AS int) AS k_neighbors, round(d, 6) AS optimal_eps, cast(place AS int) AS knee_index FROM s
    ORDER BY jump DESC NULLS LAST, place LIMIT 1""",
)
plain(
    "kdistance_customers",
    """WITH p AS (SELECT a.c_custkey AS i, sqrt((a.c_acctbal - b.c_acctbal) * (a.c_acctbal - b.c_acctbal)
        + (a.c_nationkey - b.c_nationkey) * (a.c_nationkey - b.c_nationkey)) AS d FROM customer a, customer b),
    d AS (SELECT d, row_number() OVER (PARTITION BY i ORDER BY d) AS k FROM p),
    s AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS place, lead(d) OVER (ORDER BY d) - d AS jump FROM d WHERE k = 5)
    SELECT cast(5 AS int) AS k_neighbors, round(d, 6) AS optimal_eps, cast(place AS int) AS knee_index FROM s
    ORDER BY jump DESC NULLS LAST, place LIMIT 1""",
)
plain(
    "lof_balances",
    """WITH d AS (SELECT a.s_suppkey AS i, b.s_suppkey AS j, abs(a.s_acctbal - b.s_acctbal) AS d,
      row_number() OVER (PARTITION BY a.s_suppkey ORDER BY abs(a.s_acctbal - b.s_acctbal), b.s_suppkey) AS k
      FROM supplier a JOIN supplier b ON a.s_suppkey <> b.s_suppkey),
    nn AS (SELECT i, j, d FROM d WHERE k <= 20), kd AS (SELECT i, max(d) AS reach FROM nn GROUP BY i),
    dens AS (SELECT nn.i, 1 / (avg(greatest(reach, d)) + 1e-10) AS dens FROM nn JOIN kd ON kd.i = nn.j GROUP BY nn.i),
    lof AS (SELECT nn.i, avg(o.dens) / any_value(own.dens) AS lof FROM nn JOIN dens o ON o.i = nn.j JOIN dens own ON own.i = nn.i
      GROUP BY nn.i)
    SELECT s_acctbal AS value, count(*) AS ties, round(any_value(lof), 6) AS lof FROM lof JOIN supplier ON s_suppkey = i
    GROUP BY s_acctbal""",
)

# --- text ------------------------------------------------------------------------------------------------------------------------------


def tfidf(head: str, source: str, key: str, column: str) -> str:
    """Every n-gram is counted, without any pruning."""
    return (
        head
        + f"""tok AS (SELECT {key} AS doc, [w FOR w IN regexp_extract_all(lower(coalesce({column}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')
      IF w NOT IN ({words(ENGLISH_STOP_WORDS)})] AS ws FROM {source}),
    terms AS (
      SELECT doc, unnest(ws) AS term FROM tok
      UNION ALL SELECT doc, unnest([concat(ws[i], ' ', ws[i + 1]) FOR i IN range(1, len(ws))]) FROM tok
      UNION ALL SELECT doc, unnest([concat(ws[i], ' ', ws[i + 1], ' ', ws[i + 2]) FOR i IN range(1, len(ws) - 1)]) FROM tok),
    tf AS (SELECT doc, term, count(*) AS tf FROM terms GROUP BY doc, term),
    kept AS (SELECT term, sum(tf) AS c, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2 ORDER BY c DESC, term LIMIT 100),
    w AS (SELECT doc, term, tf * (ln((1 + (SELECT count(*) FROM {source})) / (1 + df)) + 1) AS w FROM tf JOIN kept USING (term)),
    s AS (SELECT term, sum(w / l) / (SELECT count(*) FROM {source}) AS score FROM w
          JOIN (SELECT doc, sqrt(sum(w * w)) AS l FROM w GROUP BY doc) USING (doc) GROUP BY term)
    SELECT term, round(score, 8) AS score FROM s ORDER BY s.score DESC, term LIMIT 30"""
    )


plain("tfidf_keywords", tfidf("WITH ", "documents", "doc_id", "text"))
plain("tfidf_titles", tfidf(LISTINGS + ", ", "listings", "id", "product_name"))
PATTERNS = """SELECT category AS dominant_category, count(*) AS dominant_count,
    (SELECT avg(length(product_name)) FROM listings) AS avg_name_length FROM listings GROUP BY category
    ORDER BY count(*) DESC, category LIMIT 1"""
listings(
    "name_patterns",
    f"SELECT dominant_category, dominant_count, round(avg_name_length, 6) AS avg_name_length FROM ({PATTERNS})",
)


def hits(column: str, values: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"cast(contains(lower(coalesce({column}, '')), '{w}') AS int)" for w in values) + ")"


plain(
    "quality_word_counts",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS word_set, cast(sum({hits('text', values)}) AS bigint) AS hits,
        count(*) FILTER ({hits('text', values)} > 0) AS rows_with_hit,
        round(sum({hits('text', values)}) * 100 / count(*), 6) AS hits_pct FROM documents"""
        for name, values in (("quality", QUALITY_WORDS), ("budget", BUDGET_WORDS))
    ),
)
plain(
    "word_frequencies",
    f"""WITH t AS (SELECT regexp_replace(unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_'']*')), '''s$', '')
    AS word FROM documents), k AS (SELECT word, count(*) AS count FROM t WHERE word NOT IN ({words(CLOUD_STOP_WORDS)})
    AND NOT regexp_matches(word, '^\\p{{Nd}}+$') GROUP BY word ORDER BY count DESC, word LIMIT 120)
    SELECT word, count, round(count / (SELECT max(count) FROM k), 8) AS weight FROM k""",
)

def word_cloud(head: str, source: str, column: str) -> str:
    """Every pair of neighbours is counted, without any pruning."""
    stop = words(CLOUD_STOP_WORDS)
    log_l = lambda k, of, p: f"(ln(greatest({p}, 1e-10)) * {k} + ln(greatest(1 - {p}, 1e-10)) * ({of} - {k}))"
    p, p1, p2 = "(c2 / n)", "(c12 / c1)", "((c2 - c12) / (n - c1))"
    ratio = f"-2 * ({log_l('c12', 'c1', p)} + {log_l('(c2 - c12)', '(n - c1)', p)} - {log_l('c12', 'c1', p1)} - {log_l('(c2 - c12)', '(n - c1)', p2)})"
    plural = "suffix({0}, 's') AND NOT suffix({0}, 'ss') AND length({0}) > 1"
    return (
        head
        + f"""lists AS MATERIALIZED (SELECT list_filter(list_transform(regexp_extract_all(lower(coalesce({column}, '')),
      '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_'']*'), lambda w: regexp_replace(w, '''s$', '')), lambda w: NOT regexp_matches(w, '^\\p{{Nd}}+$')) AS ws FROM {source}),
    raw AS (SELECT word, count(*) AS c FROM (SELECT unnest(ws) AS word FROM lists) WHERE word NOT IN ({stop}) GROUP BY word),
    forms AS MATERIALIZED (SELECT r.word, r.c, coalesce(s.word, r.word) AS form FROM raw r LEFT JOIN raw s
      ON s.word = left(r.word, -1) AND {plural.format('r.word')}),
    counts AS MATERIALIZED (SELECT form, sum(c)::double AS c FROM forms GROUP BY form),
    pairs AS MATERIALIZED (SELECT p.a, p.b, count(*) AS c FROM (SELECT unnest([{{'a': ws[i], 'b': ws[i + 1]}} FOR i IN range(1, len(ws))]) AS p FROM lists)
      WHERE p.a NOT IN ({stop}) AND p.b NOT IN ({stop}) GROUP BY ALL),
    folded AS (SELECT p.a, coalesce(s.b, p.b) AS b, sum(p.c)::double AS c12 FROM pairs p LEFT JOIN pairs s
      ON s.a = p.a AND s.b = left(p.b, -1) AND {plural.format('p.b')} GROUP BY 1, 2),
    sized AS (SELECT a, b, c12, fa.form AS f1, fb.form AS f2, ca.c AS c1, cb.c AS c2, (SELECT sum(c) FROM counts) AS n FROM folded
      JOIN forms fa ON fa.word = a JOIN forms fb ON fb.word = b JOIN counts ca ON ca.form = fa.form JOIN counts cb ON cb.form = fb.form),
    kept AS MATERIALIZED (SELECT * FROM sized WHERE n > c1 AND n > c2 AND {ratio} > 30),
    taken AS (SELECT form, sum(c12) AS t FROM (SELECT f1 AS form, c12 FROM kept UNION ALL SELECT f2, c12 FROM kept) GROUP BY form),
    terms AS (SELECT form AS word, c - coalesce(t, 0) AS c FROM counts LEFT JOIN taken USING (form) WHERE c - coalesce(t, 0) > 0
      UNION ALL SELECT a || ' ' || b, c12 FROM kept),
    k AS (SELECT * FROM terms ORDER BY c DESC, word LIMIT 120)
    SELECT word, cast(c AS bigint) AS count, round(c / (SELECT max(c) FROM k), 8) AS weight, left(word, 18) AS label FROM k"""
    )


plain("word_cloud", word_cloud("WITH ", "documents", "text"))
listings("word_cloud_titles", ", " + word_cloud("", "listings", "product_name"))

# --- chart tables ----------------------------------------------------------------------------------------------------------------------


def histogram(value: str, bins: int, edges: bool = True) -> str:
    kept = ", lo + bin * (hi - lo) / {b} AS bin_start, lo + (bin + 1) * (hi - lo) / {b} AS bin_end".format(b=bins)
    return f""", v AS (SELECT {value} AS v FROM listings WHERE {value} IS NOT NULL), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
    h AS (SELECT cast(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS int) AS bin, count(*) AS c FROM v, e GROUP BY 1),
    b AS (SELECT cast(unnest(range({bins})) AS int) AS bin)
    SELECT b.bin{kept if edges else ''}, coalesce(c, 0) AS count FROM b LEFT JOIN h ON b.bin = h.bin CROSS JOIN e"""


listings("histogram", histogram("price_min", 40).replace("bin *", "b.bin *").replace("(bin +", "(b.bin +"))
listings("histogram_log", histogram("log10(price_min + 1)", 40, edges=False))
listings(
    "histogram_spread", histogram("(price_max - price_min)", 40).replace("bin *", "b.bin *").replace("(bin +", "(b.bin +")
)
listings("histogram_quality", histogram("quality_score", 30).replace("bin *", "b.bin *").replace("(bin +", "(b.bin +"))
listings(
    "percentile_bars",
    " UNION ALL ".join(
        f"SELECT 'P{p}' AS percentile, round(quantile_cont(price_min, {p / 100}), 6) AS value FROM listings"
        for p in (5, 10, 25, 50, 75, 90, 95, 99)
    ),
)
BOXES = """, bq AS (SELECT category, quantile_cont(price_min, 0.25) AS q1, quantile_cont(price_min, 0.5) AS median,
  quantile_cont(price_min, 0.75) AS q3 FROM listings GROUP BY category),
  bi AS (SELECT *, price_min BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM listings JOIN bq USING (category)),
  boxes AS (SELECT category, min(price_min) FILTER (inside) AS whisker_low, max(price_min) FILTER (inside) AS whisker_high,
    avg(price_min) AS mean, stddev_samp(price_min) AS std, count(*) FILTER (NOT inside) AS outliers, any_value(q1) AS q1,
    any_value(median) AS median, any_value(q3) AS q3 FROM bi GROUP BY category)"""
listings(
    "box_stats",
    """SELECT category, whisker_low, whisker_high, round(mean, 4) AS mean, round(std, 4) AS std, outliers,
    round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3 FROM boxes""",
    BOXES,
)
listings(
    "violin_density",
    """, sp AS (SELECT category, min(price_min) AS lo, max(price_min) AS hi, count(*)::double AS n, stddev_samp(price_min) AS sd
      FROM listings GROUP BY category),
    h AS (SELECT category, least(floor((price_min - lo) / ((hi - lo) / 512)), 511) AS bin, count(*) AS c
      FROM listings JOIN sp USING (category) GROUP BY 1, 2),
    pt AS (SELECT *, cast(unnest(range(100)) AS int) AS point, sd * power(n, -0.2) AS bw FROM sp)
    SELECT category, point, round(lo + point * (hi - lo) / 99, 6) AS x,
    round(1e9 * sum(c * exp(-power((lo + point * (hi - lo) / 99 - (lo + (bin + 0.5) * (hi - lo) / 512)) / bw, 2) / 2)
      / (sqrt(2 * pi()) * bw) / n), 3) AS density
    FROM pt JOIN h USING (category) GROUP BY category, point, lo, hi""",
)


def bars(chart: str, item: str, k: int | None) -> str:
    cut = f"ORDER BY count DESC, item LIMIT {k}" if k else ""
    return f"""(SELECT '{chart}' AS chart, {item} AS item, count(*) AS count,
    round(count(*) / (SELECT count(*) FROM listings), 8) AS share FROM listings GROUP BY item {cut})"""


listings(
    "count_bars",
    " UNION ALL ".join(
        [
            bars("categories", "category", 12),
            bars("cities", "city", 15),
            bars("suppliers", "supplier_name", 15),
            bars("verification", "CASE WHEN supplier_verified THEN 'Verified' ELSE 'Unverified' END", None),
        ]
    ),
)
listings(
    "market_hierarchy",
    """SELECT category, city, CASE grouping(category, city) WHEN 0 THEN 'city' WHEN 1 THEN 'category' ELSE 'total' END AS level,
    count(product_name) AS count, round(avg(price_min), 4) AS avg_price FROM listings GROUP BY ROLLUP (category, city)""",
)
listings(
    "category_funnel",
    """SELECT category, count, round(count * 100 / max(count) OVER (), 6) AS pct_of_first FROM
    (SELECT category, count(*) AS count FROM listings GROUP BY category ORDER BY count DESC, category LIMIT 8)""",
)
listings(
    "volume_vs_price",
    "SELECT category, count(product_name) AS count, round(avg(price_min), 4) AS avg_price FROM listings GROUP BY category",
)


def panel(dashboard: str, name: str, item: str, value: str, source: str) -> str:
    return f"""SELECT '{dashboard}' AS dashboard, '{name}' AS panel, cast({item} AS varchar) AS item,
    round(cast({value} AS double), 6) AS value FROM ({source})"""


def top_counts(column: str, k: int) -> str:
    return f"SELECT {column}, count(*) AS c FROM listings GROUP BY {column} ORDER BY c DESC, {column} LIMIT {k}"


_HISTOGRAM_30 = histogram("price_min", 30, edges=False)
listings(
    "dashboard_panels",
    " UNION ALL ".join(
        [
            panel("executive", "price_distribution", "bin", "count", _HISTOGRAM_30[_HISTOGRAM_30.index("SELECT b.bin") :]),
            panel("executive", "top_categories", "category", "c", top_counts("category", 6)),
            panel("executive", "top_cities", "city", "c", top_counts("city", 8)),
            *[
                panel(
                    "executive",
                    "category_boxes",
                    f"concat(category, '/{part}')",
                    part,
                    "SELECT * FROM boxes ORDER BY category LIMIT 5",
                )
                for part in ("whisker_low", "q1", "median", "q3", "whisker_high")
            ],
            panel(
                "executive",
                "verification",
                "flag",
                "c",
                "SELECT CASE WHEN supplier_verified THEN 'Verified' ELSE 'Unverified' END AS flag, count(*) AS c FROM listings GROUP BY 1",
            ),
            panel(
                "executive", "avg_price", "category", "avg_price", CATEGORY_MEANS + " ORDER BY avg_price DESC, category LIMIT 8"
            ),
            panel("category", "count", "category", "count", DEEP_DIVE),
            panel("category", "avg_price", "category", "avg_min", DEEP_DIVE),
            panel("category", "price_range", "category", "range", DEEP_DIVE),
            panel("category", "volatility", "category", "std", DEEP_DIVE),
        ]
    ),
    BOXES + _HISTOGRAM_30[: _HISTOGRAM_30.index("SELECT b.bin")],
)
listings(
    "insights_patterns",
    f""", pat AS ({PATTERNS}), st AS ({pairs("SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r", which=lambda i, j: i < j)}),
    qw AS (SELECT sum({hits('product_name', QUALITY_WORDS)}) AS h, count(*) AS n FROM listings)
    SELECT 'strong_correlation' AS rule, 'info' AS severity, concat(a, '/', b) AS metric, round(r, 6) AS value,
    concat('Strong ', CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END, ' correlation (', printf('%.2f', r), ') between ', a,
      ' and ', b) AS text FROM st WHERE abs(r) > 0.7
    UNION ALL SELECT 'dominant_category', 'info', dominant_category, cast(dominant_count AS double),
    concat('Dominant category: ', dominant_category, ' (', dominant_count, ' products)') FROM pat
    UNION ALL SELECT 'name_length', 'info', 'avg_name_length', round(avg_name_length, 6),
    concat('Average product name length: ', printf('%.0f', avg_name_length), ' characters') FROM pat
    UNION ALL SELECT 'quality_words', 'info', 'hits', cast(h AS double),
    concat('Quality-indicator products: ', cast(h AS bigint), ' (', printf('%.1f', h * 100 / n), '%)') FROM qw""",
)


def kmeans_rounds(k: int = 5, rounds: int = 3) -> str:
    """Rounds of k-means from the k rows of lowest id, one query after the other."""
    steps = [f", c0 AS (SELECT row_number() OVER (ORDER BY id) - 1 AS c, x AS cx, y AS cy FROM sc QUALIFY c < {k})"]
    for r in range(rounds):
        steps.append(
            f""", a{r} AS MATERIALIZED (SELECT id, x, y, arg_min(c, g) AS c, min(g) AS g FROM (
            SELECT id, x, y, c, power(x - cx, 2) + power(y - cy, 2) AS g FROM sc, c{r}) GROUP BY id, x, y),
            c{r + 1} AS (SELECT p.c, coalesce(avg(x), any_value(cx)) AS cx, coalesce(avg(y), any_value(cy)) AS cy, count(id) AS size,
            coalesce(sum(g), 0) AS cost FROM c{r} p LEFT JOIN a{r} ON a{r}.c = p.c GROUP BY p.c)"""
        )
    return "".join(steps) + f"""SELECT cast(c AS int) AS cluster, size, round(cost, 4) AS cost, round(cx, 6) AS price_min,
    round(cy, 6) AS price_max FROM c{rounds}"""


listings("kmeans_rounds", kmeans_rounds(), SCALED_PRICES)
# One component per category, from fixed memberships: likelihood of the mixture of their normal laws.
listings(
    "mixture_scores",
    """, comp AS (SELECT category, count(*) / (SELECT count(*) FROM sc)::double AS w, avg(x) AS mx, avg(y) AS my, var_pop(x) + 1e-6 AS vx,
      var_pop(y) + 1e-6 AS vy, covar_pop(x, y) AS v FROM sc GROUP BY category),
    dens AS (SELECT id, sum(w * exp(-(vy * (x - mx) * (x - mx) - 2 * v * (x - mx) * (y - my) + vx * (y - my) * (y - my))
      / (2 * (vx * vy - v * v))) / (2 * pi() * sqrt(vx * vy - v * v))) AS f FROM sc, comp GROUP BY id),
    s AS (SELECT sum(ln(f)) AS ll, count(*)::double AS n, (SELECT count(*) FROM comp) AS k FROM dens)
    SELECT cast(k AS int) AS n_components, round(ll, 2) AS log_likelihood, round(-2 * ll + (6 * k - 1) * ln(n), 2) AS bic,
    round(-2 * ll + 2 * (6 * k - 1), 2) AS aic FROM s""",
    SCALED_PRICES,
)
# One reweighting from the medians: the 50 % and 97.5 % points of the chi-square law with two degrees of freedom are closed forms.
listings(
    "robust_reweighting",
    """, med AS (SELECT median(price_min) AS mx, median(price_max) AS my FROM listings),
    mad AS (SELECT mx, my, power(1.4826 * median(abs(price_min - mx)), 2) AS vx, power(1.4826 * median(abs(price_max - my)), 2) AS vy
      FROM listings, med GROUP BY mx, my),
    d AS (SELECT price_min AS x, price_max AS y, power(price_min - mx, 2) / vx + power(price_max - my, 2) / vy AS d FROM listings, mad),
    k AS (SELECT x, y FROM d WHERE d / ((SELECT median(d) FROM d) / (-2 * ln(0.5))) < -2 * ln(0.025)),
    s AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, x) AS vx, covar_pop(x, y) AS v, covar_pop(y, y) AS vy FROM k)
    SELECT unnest(['location price_min', 'location price_max', 'scatter price_min price_min', 'scatter price_min price_max',
      'scatter price_max price_max']) AS element, unnest([round(mx, 3), round(my, 3), round(vx, 3), round(v, 3), round(vy, 3)]) AS value
    FROM s""",
)


def free_location(points: int = 41, plane: int = 15, rounds: int = 9) -> str:
    """Likelihoods with the location sought by ever finer grids of its gap to the smallest value; gamma's shape by Newton steps whose
    digamma function is a difference of lgamma."""
    at = lambda lo, hi, i, n: f"exp({lo} + ({hi} - {lo}) * {i} / {n - 1}.0)"
    zoom = f"greatest(b0, u - (hi - lo) / {points - 1}) AS lo, least(b1, u + (hi - lo) / {points - 1}) AS hi"

    def line(name: str, ll: str) -> str:
        return f"""
    {name} AS (SELECT 0 AS r, ln(1e-3 * sd) AS lo, ln(1e2 * sd) AS hi, ln(1e-3 * sd) AS b0, ln(1e2 * sd) AS b1, -1e300::double AS ll FROM p
      UNION ALL SELECT r + 1, {zoom}, b0, b1, ll FROM (
        SELECT r, lo, hi, b0, b1, max({ll}) AS ll, arg_max(lo + (hi - lo) * i / {points - 1}.0, {ll}) AS u FROM (
          SELECT r, lo, hi, b0, b1, i, g, n, mx - low + g AS m1, avg(ln(x - low + g)) AS m, greatest(var_pop(ln(x - low + g)), 1e-300) AS v FROM (
            SELECT z.*, i, {at('lo', 'hi', 'i', points)} AS g FROM {name} z, range({points}) AS t(i) WHERE r < {rounds}), d
          GROUP BY ALL) GROUP BY r, lo, hi, b0, b1))"""

    dig = "((lgamma(a * 1.0001) - lgamma(a * 0.9999)) / (a * 0.0002))"
    tri = "((lgamma(a * 1.001) - 2 * lgamma(a) + lgamma(a * 0.999)) / power(a * 0.001, 2))"
    gap = "(ln(m1) - m)"
    start = f"((3 - {gap} + sqrt(power({gap} - 3, 2) + 24 * {gap})) / (12 * {gap}))"
    newton = f"list_reduce(list_prepend({start}, [0.0 FOR i IN range(12)]), lambda a, i: greatest(a / 2, a - (ln(a) - {dig} - {gap}) / (1 / a - {tri})))"
    gamma = f"(({newton} - 1) * m - {newton} - lgamma({newton}) - {newton} * ln(m1 / {newton}))"
    return f""", p AS (SELECT avg(price_min) AS mx, stddev_pop(price_min) AS sd, min(price_min) AS low, count(*)::double AS n FROM listings),
    d AS (SELECT price_min AS x, mx, low, n FROM listings, p),
    {line('logn', '(-(0.5 * ln(v) + m + 0.5 * ln(2 * pi()) + 0.5))')},
    {line('gam', gamma)},
    weib AS (SELECT 0 AS r, ln(1e-3 * sd) AS lo, ln(1e2 * sd) AS hi, ln(0.05) AS cl, ln(50.0) AS ch, ln(1e-3 * sd) AS b0, ln(1e2 * sd) AS b1,
        -1e300::double AS ll FROM p
      UNION ALL SELECT r + 1, greatest(b0, u - 3 * (hi - lo) / {plane - 1}), least(b1, u + 3 * (hi - lo) / {plane - 1}),
        greatest(ln(0.05), lc - 3 * (ch - cl) / {plane - 1}), least(ln(50.0), lc + 3 * (ch - cl) / {plane - 1}), b0, b1, ll FROM (
        SELECT r, lo, hi, cl, ch, b0, b1, max(ll) AS ll, arg_max(lo + (hi - lo) * i / {plane - 1}.0, ll) AS u,
          arg_max(cl + (ch - cl) * j / {plane - 1}.0, ll) AS lc FROM (
          SELECT r, lo, hi, cl, ch, b0, b1, i, j, ln(c) - ln(avg(exp(c * ln((x - low + g) / s)))) - c * ln(s) + (c - 1) * avg(ln(x - low + g)) - 1 AS ll FROM (
            SELECT z.*, i, j, sd, {at('lo', 'hi', 'i', plane)} AS g, {at('cl', 'ch', 'j', plane)} AS c, sd + {at('lo', 'hi', 'i', plane)} AS s
            FROM weib z, p, range({plane}) AS t(i), range({plane}) AS o(j) WHERE r < {rounds + 5}), d
          GROUP BY r, lo, hi, cl, ch, b0, b1, i, j, c, s) GROUP BY r, lo, hi, cl, ch, b0, b1)),
    f AS (SELECT 'norm' AS distribution, 2 AS k, -(ln(sd) + 0.5 * ln(2 * pi()) + 0.5) AS ll FROM p
      UNION ALL SELECT 'expon', 2, -ln(mx - low) - 1 FROM p
      UNION ALL SELECT 'lognorm', 3, max(ll) FROM logn UNION ALL SELECT 'gamma', 3, max(ll) FROM gam
      UNION ALL SELECT 'weibull_min', 3, max(ll) FROM weib)
    SELECT distribution, cast(k AS int) AS n_params, round(ll * n, 2) AS log_likelihood, round(2 * k - 2 * ll * n, 2) AS aic,
    round(k * ln(n) - 2 * ll * n, 2) AS bic, 2 * k - 2 * ll * n = min(2 * k - 2 * ll * n) OVER () AS is_best FROM f, p"""


ORACLE["fit_free_location"] = LISTINGS.replace("WITH ", "WITH RECURSIVE ", 1) + free_location()
