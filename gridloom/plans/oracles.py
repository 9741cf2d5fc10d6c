"""SQL twins of the registered queries, for a second engine over the same tables."""

from __future__ import annotations

_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_KEY = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, 42))"

_EVENT_KEY = "md5(concat_ws('|', event_id, 42))"

_RAW = f"""raw AS (
  SELECT {_IDS},
    CASE WHEN l_discount = 0.0 THEN 'three' WHEN l_discount = 0.01 THEN NULL
         WHEN l_discount = 0.02 THEN ' ' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.5 '
         WHEN l_discount = 0.03 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'e1'
         WHEN l_discount = 0.04 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || 'd'
         ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS qty_text,
    CASE l_linenumber WHEN 1 THEN 'True' WHEN 2 THEN 'false' WHEN 3 THEN '1' WHEN 4 THEN '0'
         WHEN 5 THEN 'yes' WHEN 6 THEN NULL ELSE 'T' END AS flag_text,
    CASE WHEN l_returnflag = 'N' AND l_tax < 0.03 THEN 'nan' ELSE l_returnflag END AS cat_text,
    CAST(CAST(round(l_tax * 100) AS INT) AS VARCHAR) AS tax_text
  FROM lineitem)"""

_FLAG = "CASE WHEN flag_text IN ('True', 'true', '1') THEN TRUE WHEN flag_text IN ('False', 'false', '0') THEN FALSE END"
_TYPED = f"""SELECT {_IDS}, try_cast(qty_text AS DOUBLE) AS qty_text, {_FLAG} AS flag_text,
  nullif(cat_text, 'nan') AS cat_text, try_cast(tax_text AS DOUBLE) AS tax_text FROM raw"""

_LINE = f"""line AS (
  SELECT {_IDS},
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
    CASE WHEN l_tax = 0.0 THEN NULL ELSE l_quantity END AS quantity,
    l_extendedprice AS price,
    CASE WHEN l_discount < 0.09 THEN l_discount END AS discount,
    CASE WHEN month(l_shipdate) <> 12 THEN CAST(month(l_shipdate) AS VARCHAR) END AS ship_month,
    CASE WHEN l_tax <> 0.08 THEN CAST(l_linenumber AS VARCHAR) END AS line_no,
    CASE WHEN l_discount <> 0.0 THEN CAST(year(l_shipdate) AS VARCHAR) END AS ship_year,
    CASE WHEN l_quantity >= 3 THEN l_linestatus = 'F' END AS is_f,
    CASE WHEN l_discount <> 0.05 THEN l_tax > 0.04 END AS high_tax
  FROM lineitem)"""


def _fold_ctes(source: str, key: str, label: str | None, k: int = 5) -> str:
    """Ranks inside each class, cut into k ranges whose sizes continue the round of the earlier classes."""
    group = label or "0"
    return f"""ranked AS (
  SELECT *, {group} AS grp, row_number() OVER (PARTITION BY {group} ORDER BY {key}) - 1 AS rnk FROM {source}),
classes AS (
  SELECT grp, n, sum(n) OVER (ORDER BY grp) - n AS start FROM (SELECT grp, count(*) AS n FROM ranked GROUP BY grp)),
parts AS (
  SELECT grp, f, n // {k} + CASE WHEN (((f - start) % {k}) + {k}) % {k} < n % {k} THEN 1 ELSE 0 END AS size
  FROM classes, range({k}) AS t(f)),
bounds AS (
  SELECT grp, f, sum(size) OVER (PARTITION BY grp ORDER BY f) - size AS lo, sum(size) OVER (PARTITION BY grp ORDER BY f) AS hi FROM parts),
folded AS (
  SELECT ranked.*, CAST(b.f AS INT) AS fold FROM ranked JOIN bounds b ON b.grp = ranked.grp AND rnk >= b.lo AND rnk < b.hi)"""


_FOLDED = f"{_LINE}, {_fold_ctes('line', _KEY, 'label')}"

_SCORED = f"""scored AS (
  SELECT {_IDS}, l_returnflag, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS label, l_extendedprice / 105000.0 AS score FROM lineitem)"""


def _auc(source: str, by: list[str]) -> str:
    keys = "".join(f"{name}, " for name in by)
    partition = f"PARTITION BY {', '.join(by)}" if by else ""
    grouping = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT {keys}CAST(sum(pos * (below + neg / 2.0)) AS DOUBLE) / nullif(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS auc
  FROM (SELECT *, coalesce(sum(neg) OVER ({partition} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT {keys}score, sum(label) AS pos, sum(1 - label) AS neg FROM {source} GROUP BY {keys}score)) {grouping}"""


_TRIALS = f"""{_SCORED}, {_fold_ctes('scored', _KEY, 'label')},
trial_rows AS (SELECT *, l_linenumber - 1 AS trial_number FROM folded),
trials AS (SELECT trial_number, avg(auc) AS value, count(*) AS n_folds FROM ({_auc('trial_rows', ['trial_number', 'fold'])}) GROUP BY trial_number)"""

_CONTRIBUTIONS = """c AS (
  SELECT l_quantity - 25.5 AS quantity, (l_extendedprice - 50000) / 1000 AS price,
    (l_discount - 0.05) * 100 AS discount, (l_tax - 0.04) * 100 AS tax FROM lineitem),
importance AS (
  SELECT 'quantity' AS feature, round(avg(abs(quantity)), 6) AS importance FROM c UNION ALL
  SELECT 'price', round(avg(abs(price)), 6) FROM c UNION ALL
  SELECT 'discount', round(avg(abs(discount)), 6) FROM c UNION ALL
  SELECT 'tax', round(avg(abs(tax)), 6) FROM c)"""

_NUMBER = r"'^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)\s*$'"
_RAW_COLUMNS = ["qty_text", "flag_text", "cat_text", "tax_text"]


def _draft(name: str) -> str:
    return f"""SELECT '{name}' AS feature_name,
    CASE WHEN count(*) FILTER ({name} IN ('True', 'true', 'False', 'false')) > 0 THEN 'bool'
         WHEN count(*) FILTER (regexp_matches({name}, {_NUMBER})) * 2 > count({name}) THEN 'float' ELSE 'category' END AS type,
    CASE WHEN min({name}) <> max({name}) THEN 1 ELSE 0 END AS use,
    CASE WHEN count({name}) < count(*) THEN 'Unknown' ELSE 'mean' END AS imputation,
    CASE WHEN max(length({name})) <= 3 THEN 'One-Hot' ELSE 'none' END AS transformation,
    CASE WHEN max(length({name})) <= 3 THEN 'short' ELSE 'long' END AS super_category FROM raw"""


_SHEET = f"{_RAW}, sheet AS ({' UNION ALL '.join(_draft(name) for name in _RAW_COLUMNS)})"


def _bad(name: str) -> str:
    return f"({name} IS NOT NULL AND NOT regexp_matches({name}, {_NUMBER}))"


def _long(source: str, ids: str, names: list[str]) -> str:
    prefix = f"{ids}, " if ids else ""
    return " UNION ALL ".join(f"SELECT {prefix}'{n}' AS column_name, CAST({n} AS VARCHAR) AS value FROM {source}" for n in names)


def _profile() -> str:
    ids = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_suppkey", "bigint")]
    rows = [f"SELECT '{n}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({n}) AS n_missing, 0 AS n_not_numeric FROM raw" for n, t in ids]
    rows += [f"SELECT '{n}', 'string', count(*), count(*) - count({n}), count(*) FILTER ({_bad(n)}) FROM raw" for n in _RAW_COLUMNS]
    return f"WITH {_RAW} " + " UNION ALL ".join(rows)


def _problems() -> str:
    summary = " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) FILTER ({_bad(n)}) AS n_not_numeric, count(*) FILTER ({_bad(n)}) = 0 AS is_numeric, "
        f"count(*) FILTER (contains({n}, 'e')) > 0 AND count(*) FILTER ({_bad(n)}) > 0 AS contains_e FROM raw"
        for n in _RAW_COLUMNS
    )
    cells = _long("keyed", "k", _RAW_COLUMNS)
    return f"""WITH {_RAW}, keyed AS (SELECT {_KEY} AS k, * FROM raw), summary AS ({summary}),
samples AS (SELECT column_name, string_agg(value, ' | ' ORDER BY pos) AS samples FROM (
    SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY k, value) AS pos FROM ({cells}) WHERE {_bad('value')})
  WHERE pos <= 5 GROUP BY column_name)
SELECT summary.*, samples FROM summary LEFT JOIN samples USING (column_name)"""


_SCALE = "round((coalesce({c}, s.m_{c}) - s.m_{c}) / s.d_{c}, 6) + 0.0 AS num__{c}"
_STATS = "s AS (SELECT avg(quantity) AS m_quantity, stddev_pop(quantity) AS d_quantity, avg(price) AS m_price, stddev_pop(price) AS d_price FROM line)"


def _mode(column: str, source: str = "line") -> str:
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"


_LINE_NO = ", ".join(f"CAST(coalesce(line_no, {_mode('line_no')}) = '{i}' AS INT)::DOUBLE AS onehot__line_no_{i}" for i in range(1, 8))
_SHIP_YEAR = ", ".join(f"CASE WHEN ship_year = '{y}' THEN 1.0::DOUBLE ELSE 0.0 END AS onehot_na__ship_year_{y}" for y in range(1995, 2002))
_SHIP_YEAR += ", CASE WHEN ship_year IS NULL THEN 1.0::DOUBLE ELSE 0.0 END AS onehot_na__ship_year_nan"
_IS_F = "coalesce(CAST(CAST(is_f AS INT) AS DOUBLE), 0.0) AS bin__is_f"
_REMAINDER = "discount AS remainder__discount, CAST(CAST(high_tax AS INT) AS DOUBLE) AS remainder__high_tax"

_FOLD_STATS = f"""{_FOLDED},
ks AS (SELECT CAST(f AS INT) AS k FROM range(5) AS t(f)),
fs AS (SELECT k, avg(quantity) AS m_quantity, stddev_pop(quantity) AS d_quantity, avg(price) AS m_price, stddev_pop(price) AS d_price
  FROM ks JOIN folded ON fold <> k GROUP BY k),
fm AS (SELECT k, ship_month AS mode FROM (
    SELECT k, ship_month, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, ship_month) AS pos
    FROM ks JOIN folded ON fold <> k WHERE ship_month IS NOT NULL GROUP BY k, ship_month) WHERE pos = 1)"""

_DOCS = r"""docs AS (
  SELECT d.doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
    CASE WHEN len(string_split(text, ' ')) >= 20 THEN CAST(len(string_split(text, ' ')) AS DOUBLE) END AS n_words,
    CAST(len(list_distinct(string_split(text, ' '))) AS DOUBLE) / len(string_split(text, ' ')) AS distinct_share,
    CAST(length(regexp_replace(text, '[A-Za-z0-9 ]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS symbol_share,
    lang, source, CAST(quality AS INT) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
_DOC_NUMBERS = ["n_chars", "n_words", "distinct_share", "symbol_share"]
_DOC_SLICE = f"""WITH {_DOCS}, {_fold_ctes('docs', "md5(concat_ws('|', doc_id, 42))", 'label')},
s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}' for c in _DOC_NUMBERS)} FROM docs)
SELECT doc_id, label, fold, {', '.join(_SCALE.format(c=c) for c in _DOC_NUMBERS)},
  coalesce(source, {_mode('source', 'docs')}) AS cat__source,
  {', '.join(f"CAST(CAST(lang = '{v}' AS INT) AS DOUBLE) AS onehot__lang_{v}" for v in ('de', 'en', 'es', 'fr'))}
FROM folded, s"""

_HISTOGRAM = f"""WITH {_SCORED}, e AS (SELECT min(score) AS low, max(score) AS high FROM scored),
h AS (SELECT least(CAST(floor((score - low) / (high - low) * 20) AS INT), 19) AS bin, count(*) AS n FROM scored, e GROUP BY 1)
SELECT CAST(b AS INT) AS bin, round(low + b * ((high - low) / 20), 6) AS bin_start, coalesce(n, 0) AS n_rows
FROM range(20) AS t(b) CROSS JOIN e LEFT JOIN h ON h.bin = b"""

_FIRST_SEEN = """d AS (SELECT value, row_number() OVER (ORDER BY first, value) - 1 AS code
  FROM (SELECT CAST(o_custkey AS VARCHAR) AS value, min(o_orderkey) AS first FROM orders GROUP BY 1))"""

_CLASSES = ", ".join(f"list_sum(list_transform(embedding[{i * 8 + 1}:{i * 8 + 8}], lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))" for i in range(8))
_ARGMAX = f"""WITH e AS (SELECT vec_id, [{_CLASSES}] AS e FROM embeddings), p AS (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM e)
SELECT {', '.join(f'round(p[{i + 1}], 6) AS prob_class_{i}' for i in range(8))},
  CAST(list_position(p, list_max(p)) - 1 AS INT) AS prediction, vec_id FROM p"""

# A saturated tree on one nominal feature: the margin of a value is the mean of the labels coded -1/+1.
_GROUPED = f"""{_LINE}, grouped AS (SELECT {_IDS}, CASE WHEN price > 40000 THEN 1 ELSE 0 END AS label, coalesce(line_no, '?') AS line_no FROM line)"""
_MARGINS = f"""{_GROUPED}, margins AS (SELECT line_no, avg(2.0::DOUBLE * label - 1) AS margin FROM grouped GROUP BY line_no),
bias AS (SELECT avg(2.0::DOUBLE * label - 1) AS bias FROM grouped)"""
_GROUP_VALUES = f"""WITH {_MARGINS} SELECT {_IDS}, round(bias, 6) AS bias, round(margin, 6) AS margin, round(margin - bias, 6) + 0.0 AS contribution
FROM grouped JOIN margins USING (line_no) CROSS JOIN bias"""
_GROUP_SEARCH = f"""WITH {_GROUPED}, {_fold_ctes('grouped', _KEY, 'label', 3)},
ks AS (SELECT CAST(f AS INT) AS k FROM range(3) AS t(f)),
m AS (SELECT k, line_no, avg(2.0::DOUBLE * label - 1) AS score FROM ks JOIN folded ON fold <> k GROUP BY k, line_no),
v AS (SELECT fold, label, score FROM folded JOIN m ON m.k = fold AND m.line_no = folded.line_no)
SELECT 0 AS trial_number, fold, round(auc, 6) AS metric FROM ({_auc('v', ['fold'])})"""

_EVENT_MEANS = "m AS (SELECT event_type, avg(value) AS m, (SELECT avg(value) FROM events) AS b FROM events GROUP BY event_type)"
_EVENT_STUDY = f"""WITH {_fold_ctes('events', _EVENT_KEY, None, 3)},
ks AS (SELECT CAST(f AS INT) AS k FROM range(3) AS t(f)),
m AS (SELECT k, event_type, avg(value) AS m FROM ks JOIN folded ON fold <> k GROUP BY k, event_type),
e AS (SELECT fold, sqrt(avg((value - m) * (value - m))) AS rmse FROM folded JOIN m ON m.k = fold AND m.event_type = folded.event_type GROUP BY fold)
SELECT 0 AS trial_number, round(avg(rmse), 6) AS value, 'COMPLETE' AS state FROM e"""


def _first_seen_code(column: str) -> str:
    """Codes in the order of the first row; missing is a value of its own."""
    return f"""SELECT value, row_number() OVER (ORDER BY first, value NULLS FIRST) - 1 AS code FROM (
  SELECT {column} AS value, min(ROW({_IDS})) AS first FROM raw GROUP BY {column})"""


ORACLES: dict[str, str] = {
    "typed_cast": f"WITH {_RAW} {_TYPED}",
    "bool_parity": f"WITH {_RAW} SELECT {_IDS}, {_FLAG} AS as_null, coalesce({_FLAG}, TRUE) AS as_true FROM raw",
    "csv_text_roundtrip": """SELECT kind, id, id + 9007199254740993000 AS wide_id, sha256(' "' || text || '", ') AS text_sha256
FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'c', conv_id * 1000 + turn, text FROM conversations)""",
    "csv_stray_quotes": """SELECT doc_id, doc_id || '" pipe' AS size, sha256(' "x",' || chr(10) || '"y" ' || text) AS text_sha256 FROM documents""",
    "csv_scan_typed": f"""WITH {_RAW}, typed AS ({_TYPED})
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, qty_text, flag_text, cat_text, tax_text FROM typed""",
    "inferred_types": f"WITH {_RAW} "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS column_name, CASE WHEN count({n}) = 0 THEN 'string'
  WHEN count(*) FILTER ({n} IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) = count({n}) THEN 'boolean'
  WHEN count(*) FILTER (regexp_matches({n}, '^[+-]?[0-9]+$')) = count(*) THEN 'bigint'
  WHEN count(*) FILTER (regexp_matches({n}, {_NUMBER})) = count({n}) THEN 'double' ELSE 'string' END AS inferred_type FROM raw"""
        for n in _RAW_COLUMNS
    ),
    "metadata_unpivot": f"WITH {_SHEET} SELECT * FROM sheet",
    "feature_routing": f"""WITH {_SHEET}, k AS (SELECT *, lower(imputation) IN ('leave as n/a', 'unknown', 'none', 'nan', '') AS keep_missing FROM sheet WHERE use = 1)
SELECT feature_name, type, CASE
  WHEN type = 'category' AND lower(transformation) = 'one-hot' THEN CASE WHEN keep_missing THEN 'onehot_na' ELSE 'onehot' END
  WHEN type NOT IN ('float', 'number', 'category', 'bool') THEN 'none' WHEN keep_missing THEN 'remainder'
  WHEN type = 'category' THEN 'cat' WHEN type = 'bool' THEN 'bin' ELSE 'num' END AS feature_group, keep_missing FROM k""",
    "metadata_counts": f"WITH {_SHEET} SELECT type, use, count(*) AS n_features FROM sheet GROUP BY type, use",
    "scoring_projection": f"WITH {_LINE} SELECT {_IDS}, quantity, price, discount, ship_month, line_no, ship_year, is_f, high_tax FROM line",
    "profile_columns": _profile(),
    "distinct_counts": f"WITH {_RAW} "
    + " UNION ALL ".join(f"SELECT '{n}' AS column_name, count(DISTINCT {n}) AS n_distinct FROM raw" for n in [*_IDS.split(", "), *_RAW_COLUMNS]),
    "value_counts": f"WITH {_RAW} SELECT column_name, value, count(*) AS n_rows FROM ({_long('raw', '', _RAW_COLUMNS)}) GROUP BY 1, 2",
    "problem_strings": _problems(),
    "bad_numeric_cells": f"WITH {_RAW} SELECT * FROM ({_long('raw', _IDS, ['qty_text', 'tax_text'])}) WHERE {_bad('value')}",
    "bad_numeric_report": f"WITH {_RAW} SELECT * FROM ({_long('raw', _IDS, ['qty_text', 'tax_text'])}) WHERE {_bad('value')} ORDER BY {_IDS}, column_name, value LIMIT 10",
    "score_histogram": _HISTOGRAM,
    "stratified_folds": f"WITH {_FOLDED} SELECT {_IDS}, label, fold FROM folded",
    "plain_folds": f"WITH {_fold_ctes('events', _EVENT_KEY, None)} SELECT event_id, fold FROM folded",
    "fold_sizes": f"WITH {_FOLDED} SELECT fold, label, count(*) AS n_rows FROM folded GROUP BY fold, label",
    "fold_train_validation": f"WITH {_FOLDED} SELECT label, CASE WHEN fold = 2 THEN 'validation' ELSE 'train' END AS part, count(*) AS n_rows FROM folded GROUP BY 1, 2",
    "ordered_split": """SELECT o_orderkey, o_orderpriority, o_totalprice,
  CASE WHEN row_number() OVER (ORDER BY o_orderpriority, o_orderkey) <= 1000 THEN 0 ELSE 1 END AS part FROM orders""",
    "exact_sample": f"""WITH {_LINE} SELECT {_IDS}, price FROM (
  SELECT *, row_number() OVER (ORDER BY {_KEY}) AS pos, count(*) OVER () AS n FROM line) WHERE pos <= greatest(1, CAST(floor(n * 0.2) AS BIGINT))""",
    "first_rows": f"SELECT {_IDS}, l_extendedprice AS price FROM lineitem ORDER BY {_IDS} LIMIT 1000",
    "scale_fit": f"WITH {_LINE} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 5) AS mean, round(stddev_pop({c}), 5) AS std FROM line" for c in ("quantity", "price", "discount")),
    "scale_impute_apply": f"WITH {_LINE}, {_STATS} SELECT {_IDS}, {_SCALE.format(c='quantity')}, {_SCALE.format(c='price')} FROM line, s",
    "mode_impute": f"WITH {_LINE} SELECT {_IDS}, coalesce(ship_month, {_mode('ship_month')}) AS cat__ship_month FROM line",
    "bool_impute": f"WITH {_LINE} SELECT {_IDS}, {_IS_F} FROM line",
    "bool_as_number": f"WITH {_LINE} SELECT {_IDS}, CAST(CAST(is_f AS INT) AS DOUBLE) AS is_f, CAST(CAST(high_tax AS INT) AS DOUBLE) AS high_tax, ship_month FROM line",
    "onehot": f"WITH {_LINE} SELECT {_IDS}, {_LINE_NO} FROM line",
    "onehot_na": f"WITH {_LINE} SELECT {_IDS}, {_SHIP_YEAR} FROM line",
    "passthrough": f"WITH {_LINE} SELECT {_IDS}, {_REMAINDER} FROM line",
    "encoded_table": f"""WITH {_LINE}, {_STATS} SELECT {_IDS}, label, {_SCALE.format(c='quantity')}, {_SCALE.format(c='price')},
  coalesce(ship_month, {_mode('ship_month')}) AS cat__ship_month, {_LINE_NO}, {_SHIP_YEAR}, {_IS_F}, {_REMAINDER} FROM line, s""",
    "loo_fold_stats": f"""WITH {_FOLD_STATS}
SELECT k AS fold, 'quantity' AS feature, round(m_quantity, 5) AS mean, round(d_quantity, 5) AS std, CAST(NULL AS VARCHAR) AS mode FROM fs UNION ALL
SELECT k, 'price', round(m_price, 5), round(d_price, 5), NULL FROM fs UNION ALL
SELECT k, 'ship_month', NULL, NULL, mode FROM fm""",
    "fold_encoded_table": f"""WITH {_FOLD_STATS} SELECT {_IDS}, label, fold, {_SCALE.format(c='quantity')}, {_SCALE.format(c='price')},
  coalesce(ship_month, mode) AS cat__ship_month FROM folded JOIN fs s ON s.k = fold JOIN fm ON fm.k = fold""",
    "document_slice": _DOC_SLICE,
    "category_dictionary": f"WITH {_FIRST_SEEN} SELECT value, code FROM d",
    "category_codes": f"WITH {_FIRST_SEEN} SELECT c_custkey, code FROM customer LEFT JOIN d ON value = CAST(c_custkey AS VARCHAR)",
    "class_weights": f"""WITH {_LINE} SELECT label, n AS n_rows, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
FROM (SELECT label, count(*) AS n FROM line GROUP BY label)""",
    "roc_auc": f"WITH {_SCORED} SELECT round(auc, 6) AS rocauc FROM ({_auc('scored', [])})",
    "auc_ranges": f"WITH {_SCORED} SELECT l_returnflag, round(auc, 6) AS rocauc FROM ({_auc('scored', ['l_returnflag'])})",
    "roc_auc_by_group": f"WITH {_SCORED} SELECT l_returnflag, round(auc, 6) AS rocauc FROM ({_auc('scored', ['l_returnflag'])})",
    "threshold_metrics": f"""WITH {_SCORED}, c AS (SELECT l_returnflag, count(*) FILTER (label = 1 AND score > 0.5) AS tp, count(*) FILTER (label = 0 AND score > 0.5) AS fp,
  count(*) FILTER (label = 1 AND score <= 0.5) AS fn, count(*) FILTER (label = 0 AND score <= 0.5) AS tn FROM scored GROUP BY l_returnflag)
SELECT *, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision,
  round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy FROM c""",
    "regression_metrics": """SELECT event_type, round(sqrt(avg((value - user_id * 0.5::DOUBLE) * (value - user_id * 0.5::DOUBLE))), 6) AS rmse,
  round(avg(abs(value - user_id * 0.5::DOUBLE)), 6) AS mae FROM events GROUP BY event_type""",
    "cv_mean": f"WITH {_TRIALS} SELECT trial_number, round(value, 6) AS value, n_folds FROM trials",
    "cv_best_trial": f"WITH {_TRIALS} SELECT trial_number, round(value, 6) AS value, n_folds FROM trials ORDER BY value DESC, trial_number LIMIT 1",
    "argmax_prediction": _ARGMAX,
    "flat_prediction": f"SELECT round(1 / (1 + exp(-((l_quantity - 25) / 10))), 6) AS prediction, {_IDS} FROM lineitem",
    "mean_abs_importance": f"WITH {_CONTRIBUTIONS} SELECT * FROM importance",
    "importance_rank": f"WITH {_CONTRIBUTIONS} SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INT) AS rank FROM importance",
    "top_importance": f"WITH {_CONTRIBUTIONS} SELECT * FROM importance ORDER BY importance DESC, feature LIMIT 2",
    "importance_by_group": f"""WITH {_CONTRIBUTIONS} SELECT 'size' AS feature, round(avg(abs(quantity)), 6) AS importance FROM c UNION ALL
SELECT 'money', round(avg(abs(price + discount + tax)), 6) FROM c""",
    "group_binary": f"WITH {_MARGINS} SELECT round(1 / (1 + exp(-2 * margin)), 6) AS prediction, {_IDS} FROM grouped JOIN margins USING (line_no)",
    "group_regression": """SELECT round(m, 6) AS prediction, event_id FROM events
  JOIN (SELECT event_type, avg(value) AS m FROM events GROUP BY event_type) USING (event_type)""",
    "group_contributions_path": _GROUP_VALUES,
    "group_contributions_shap": _GROUP_VALUES,
    "group_importance": f"""WITH {_MARGINS} SELECT 'remainder__line_no' AS feature, round(avg(abs(margin - bias)), 6) AS importance, 1 AS rank
FROM grouped JOIN margins USING (line_no) CROSS JOIN bias""",
    "group_split_count": f"WITH {_GROUPED} SELECT 'remainder__line_no' AS feature, count(DISTINCT line_no) - 1 AS n_splits FROM grouped",
    "group_train_metric": f"WITH {_MARGINS}, v AS (SELECT label, margin AS score FROM grouped JOIN margins USING (line_no)) SELECT 'rocauc' AS metric, round(auc, 6) AS value FROM ({_auc('v', [])})",
    "group_surrogate": f"""WITH {_MARGINS}, f AS (SELECT line_no, margin > 0 AS up FROM grouped JOIN margins USING (line_no) ORDER BY {_IDS} LIMIT 1000),
d AS (SELECT line_no, avg(CASE WHEN up THEN 1.0::DOUBLE ELSE -1.0 END) AS m FROM f GROUP BY line_no)
SELECT round(1 / (1 + exp(-2 * m)), 6) AS prediction, {_IDS} FROM grouped JOIN d USING (line_no)""",
    "group_search": _GROUP_SEARCH,
    "non_numeric_codes": f"""WITH {_RAW}, q AS ({_first_seen_code('qty_text')}), c AS ({_first_seen_code('cat_text')})
SELECT {_IDS}, q.code AS qty_text, CAST(tax_text AS DOUBLE) AS tax_text, c.code AS cat_text
FROM raw JOIN q ON q.value IS NOT DISTINCT FROM qty_text JOIN c ON c.value IS NOT DISTINCT FROM cat_text""",
    "run_predictions": f"WITH {_EVENT_MEANS} SELECT round(m, 6) AS prediction, event_id FROM events JOIN m USING (event_type)",
    "run_study": _EVENT_STUDY,
    "run_importance": f"WITH {_EVENT_MEANS} SELECT 'cat__event_type' AS feature, round(avg(abs(m - b)), 6) AS importance FROM events JOIN m USING (event_type)",
    "run_contributions": f"""WITH {_EVENT_MEANS} SELECT event_id, round(b, 6) AS bias, round(m, 6) AS margin, round(m - b, 6) AS contribution
FROM events JOIN m USING (event_type)""",
}
ORACLES["encoder_roundtrip"] = ORACLES["encoded_table"]
ORACLES["model_roundtrip"] = ORACLES["group_binary"]
