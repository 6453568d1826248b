"""Tokenization, detokenization, encryption and protection dispatch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.functions.fpe import KeyVersion, fpe_decrypt, fpe_encrypt
from wardlake.operators import tokens as K
from wardlake.plans import derived as D
from wardlake.plans.masking_queries import RULES
from wardlake.plans.registry import query
from wardlake.session import write_through

SECRET = "test-secret"
KEYS = [KeyVersion("2B7E151628AED2A6ABF7158809CF4F3C", "39383736353433323130", 1),
        KeyVersion("EF4359D8D580AA4F7F036D6F04FC6A94", "", 2, active=False)]


INNER, OUTER = K.derived_keys(SECRET)


def sql_token(value: str, kind: str = "vaultd_", generation: str = "'0'") -> str:
    return f"'{kind}' || sha256('{OUTER}' || sha256('{INNER}' || 'd|' || {generation} || '|' || {value}))"


def _token(value: str, kind: str = "vaultd_", generation: str = "0") -> str:
    return sql_token(value, kind, f"'{generation}'")


@query("vault_tokenize", f"""
SELECT c_custkey, {_token('c_name')} AS c_name, {_token('c_mktsegment')} AS c_mktsegment FROM customer""")
def vault_tokenize(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return K.vault_tokenize(rows, ["c_name", "c_mktsegment"], secret=SECRET)[0]


@query("vault_pairs", f"""
SELECT DISTINCT {_token('value')} AS token, value, 'vault' AS kind, true AS deterministic, 0 AS generation
FROM (SELECT o_orderpriority AS value FROM orders UNION ALL SELECT o_orderstatus FROM orders)""")
def vault_pairs(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    _, pairs = K.vault_tokenize(rows, ["o_orderpriority", "o_orderstatus"], secret=SECRET)
    return pairs


@query("critical_tokenize", f"""
SELECT event_id, {_token("'user_' || user_id", 'token_')} AS consuming_user FROM events""")
def critical_tokenize(spark: SparkSession, base: str) -> DataFrame:
    rows = D.audits(spark, base).select("event_id", "consuming_user")
    return K.critical_tokenize(rows, ["consuming_user"], secret=SECRET)[0]


@query("random_tokenize_counts", """
SELECT count(*) AS cells, count(*) AS distinct_tokens, count(*) AS prefixed, count(DISTINCT event_type) AS plain_values
FROM events""")
def random_tokenize_counts(spark: SparkSession, base: str) -> DataFrame:
    """Every cell gets a token of its own; the vault still knows the few values."""
    rows = D.load(spark, base, "events").select("event_id", "event_type")
    _, pairs = K.vault_tokenize(rows, ["event_type"], deterministic=False, secret=SECRET, row_key=["event_id"])
    return pairs.agg(
        F.count(F.lit(1)).alias("cells"), F.count_distinct("token").alias("distinct_tokens"),
        F.count_if(F.col("token").startswith("vaultn_")).alias("prefixed"),
        F.count_distinct("value").alias("plain_values"))


def _tokenized_orders(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    rows = D.load(spark, base, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return K.vault_tokenize(rows, ["o_orderpriority", "o_orderstatus"], secret=SECRET)


@query("detokenize", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def detokenize(spark: SparkSession, base: str) -> DataFrame:
    """Five values hold all rows: the join has to split hot keys."""
    tokens, pairs = _tokenized_orders(spark, base)
    return K.detokenize(tokens, ["o_orderpriority", "o_orderstatus"], pairs)


@query("tokenize_roundtrip_count", """
SELECT count(*) AS rows, count(*) AS same FROM customer""")
def tokenize_roundtrip_count(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "customer").select("c_custkey", "c_name")
    tokens, pairs = K.vault_tokenize(rows, ["c_name"], secret=SECRET)
    back = K.detokenize(tokens, ["c_name"], pairs).withColumnRenamed("c_name", "back")
    return rows.join(back, "c_custkey").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("c_name") == F.col("back")).alias("same"))


@query("partial_detokenize", f"""
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN event_type WHEN user_id % 3 = 1 THEN upper({_token('event_type')})
  ELSE 'user_' || user_id END AS cell FROM events""")
def partial_detokenize(spark: SparkSession, base: str) -> DataFrame:
    """Tokens are recovered; plain text and tokens in the wrong case pass."""
    events = D.load(spark, base, "events").select("event_id", "user_id", "event_type")
    _, pairs = K.vault_tokenize(events, ["event_type"], secret=SECRET)
    token = K.deterministic_token(F.col("event_type"), "vault", SECRET)
    mixed = events.select("event_id", F.when(F.col("user_id") % 3 == 0, token)
                          .when(F.col("user_id") % 3 == 1, F.upper(token))
                          .otherwise(D.text("user_", F.col("user_id"))).alias("cell"))
    return K.partial_detokenize(mixed, ["cell"], pairs)


@query("delete_and_retokenize", f"""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN {_token('c_mktsegment', generation='1')}
  ELSE {_token('c_mktsegment')} END AS c_mktsegment FROM customer""")
def delete_and_retokenize(spark: SparkSession, base: str) -> DataFrame:
    """After deletion the same value gets a new token, which is deterministic again."""
    rows = D.load(spark, base, "customer").select("c_custkey", "c_mktsegment")
    _, vault = K.vault_tokenize(rows, ["c_mktsegment"], secret=SECRET)
    doomed = vault.filter("value IN ('BUILDING', 'MACHINERY')").select("token")
    _, retired, _ = K.delete_tokens(vault, doomed, "vault")
    return K.tokenize(rows, ["c_mktsegment"], secret=SECRET, retired=retired)[0]


def retired_events(spark: SparkSession, base: str) -> DataFrame:
    """Generations after the tokens of two event types were deleted."""
    rows = D.load(spark, base, "events").select("event_id", "event_type")
    _, vault = K.vault_tokenize(rows, ["event_type"], secret=SECRET)
    return K.delete_tokens(vault, vault.filter("value IN ('view', 'error')").select("token"), "vault")[1]


_NEXT = "CASE WHEN {0} IN ('view', 'error') THEN '1' ELSE '0' END"


@query("delete_and_retokenize_map", f"""
SELECT event_id, 'user' AS key, {_token("'user_' || user_id")} AS value, 0 AS pos FROM events
UNION ALL SELECT event_id, 'type', {sql_token('event_type', generation=_NEXT.format('event_type'))}, 1 FROM events""")
def delete_and_retokenize_map(spark: SparkSession, base: str) -> DataFrame:
    maps = D.load(spark, base, "events").select(
        "event_id", F.create_map(F.lit("user"), D.text("user_", F.col("user_id")), F.lit("type"), F.col("event_type"))
        .alias("fields"))
    out, _ = K.tokenize_map(maps, "fields", secret=SECRET, row_key=["event_id"], retired=retired_events(spark, base))
    return out.select("event_id", F.posexplode(F.map_entries("fields")).alias("pos", "e")).select(
        "event_id", "e.key", "e.value", "pos")


@query("delete_and_retokenize_protect", f"""
SELECT event_id, {sql_token('event_type', generation=_NEXT.format('event_type'))} AS event_type FROM events""")
def delete_and_retokenize_protect(spark: SparkSession, base: str) -> DataFrame:
    rows = D.load(spark, base, "events").select("event_id", "event_type")
    return K.protect_columns(rows, [K.Protection("event_type", "tokenized-vault")], RULES, "ANALYST", SECRET,
                             retired_events(spark, base))[0]


@query("random_composite_keys", """
SELECT o_orderkey, 1 AS part, o_orderstatus, true AS own_token FROM orders
UNION ALL SELECT o_orderkey, 2, o_orderstatus, true FROM orders""")
def random_composite_keys(spark: SparkSession, base: str) -> DataFrame:
    """Keys whose parts contain the separators of each other, or are null, and still get tokens of their own; all come back."""
    orders = D.load(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    order, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    one = orders.select(F.concat(F.lit("a|"), order).alias("k1"), F.concat(F.lit("c:"), customer).alias("k2"), F.lit(1).alias("part"), "*")
    two = orders.select(F.lit(None).cast("string").alias("k1"), F.concat(F.lit("a|"), order, F.lit("|c:"), customer).alias("k2"),
                        F.lit(2).alias("part"), "*")
    tokens, pairs = K.tokenize(one.unionByName(two), ["o_orderstatus"], deterministic=False, secret=SECRET, row_key=["k1", "k2"], call="c")
    uses = tokens.groupBy(F.col("o_orderstatus").alias("token")).agg(F.count(F.lit(1)).alias("n"))
    back = K.detokenize(tokens.withColumn("token", F.col("o_orderstatus")), ["o_orderstatus"], pairs)
    return back.join(uses, "token").select("o_orderkey", "part", "o_orderstatus", (F.col("n") == 1).alias("own_token"))


@query("detokenize_repeated_pairs", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def detokenize_repeated_pairs(spark: SparkSession, base: str) -> DataFrame:
    """A vault that holds each pair twice, next to pairs of the other service."""
    tokens, pairs = _tokenized_orders(spark, base)
    other = pairs.withColumns({"kind": F.lit("critical"), "value": F.lit("wrong")})
    return K.detokenize(tokens, ["o_orderpriority", "o_orderstatus"], pairs.unionByName(pairs).unionByName(other), kind="vault")


@query("delete_tokens_left", f"""
SELECT {_token('c_name')} AS token, c_name AS value FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def delete_tokens_left(spark: SparkSession, base: str) -> DataFrame:
    return _deletion(spark, base, "vault")[0].select("token", "value")


def _deletion(spark: SparkSession, base: str, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    customers = D.load(spark, base, "customer").select("c_custkey", "c_name", "c_acctbal")
    _, vault = K.vault_tokenize(customers, ["c_name"], kind=kind, secret=SECRET)
    names = D.load(spark, base, "orders").filter("o_orderstatus = 'P'").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("name"))
    asked = names.select(K.deterministic_token(F.col("name"), kind, SECRET).alias("token")).unionByName(
        customers.filter("c_acctbal < 0").select(D.text("stray_", F.col("c_custkey")).alias("token")))
    return K.delete_tokens(vault, asked, kind)


@query("delete_tokens_unknown", "SELECT 'stray_' || c_custkey AS token FROM customer WHERE c_acctbal < 0")
def delete_tokens_unknown(spark: SparkSession, base: str) -> DataFrame:
    return _deletion(spark, base, "vault")[2]


@query("tokenize_map", f"""
SELECT event_id, 'user' AS key, {_token("'user_' || user_id")} AS value, 0 AS pos FROM events
UNION ALL SELECT event_id, 'type', {_token('event_type')}, 1 FROM events""")
def tokenize_map(spark: SparkSession, base: str) -> DataFrame:
    """Row-level dictionaries: keys and their order stay."""
    maps = D.load(spark, base, "events").select(
        "event_id", F.create_map(F.lit("user"), D.text("user_", F.col("user_id")), F.lit("type"), F.col("event_type"))
        .alias("fields"))
    out, _ = K.tokenize_map(maps, "fields", secret=SECRET)
    return out.select("event_id", F.posexplode(F.map_entries("fields")).alias("pos", "e")).select(
        "event_id", "e.key", "e.value", "pos")


@query("detokenize_map", """
SELECT event_id, 'user_' || user_id AS user_name, event_type AS type_name FROM events""")
def detokenize_map(spark: SparkSession, base: str) -> DataFrame:
    maps = D.load(spark, base, "events").select(
        "event_id", F.create_map(F.lit("user"), D.text("user_", F.col("user_id")), F.lit("type"), F.col("event_type"))
        .alias("fields"))
    out, pairs = K.tokenize_map(maps, "fields", secret=SECRET)
    back = K.detokenize_map(out, "fields", pairs, ["event_id"])
    return back.select("event_id", F.col("fields")["user"].alias("user_name"), F.col("fields")["type"].alias("type_name"))


@query("check_limits", """
SELECT 'text' AS column_name, 'value_size' AS limit_name, CAST(NULL AS VARCHAR) AS batch,
  count(*) AS found, 1024 AS allowed FROM documents WHERE length(text) >= 1024
UNION ALL
SELECT 'source', 'values_per_call', lang, count(*), 4096 FROM documents GROUP BY lang HAVING count(*) > 4096
UNION ALL
SELECT 'text', 'values_per_call', lang, count(*), 4096 FROM documents GROUP BY lang HAVING count(*) > 4096""")
def check_limits(spark: SparkSession, base: str) -> DataFrame:
    return K.check_limits(D.load(spark, base, "documents"), ["text", "source"], "vault", "lang")


@query("call_batches", """
SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1024) AS BIGINT) AS batch FROM orders""")
def call_batches(spark: SparkSession, base: str) -> DataFrame:
    return K.call_batches(D.load(spark, base, "orders").select("o_orderkey"), ["o_orderkey"], "critical")


@query("protect_columns", f"""
SELECT c_custkey, {_token('c_name')} AS c_name, c_nationkey, CAST(1 AS DOUBLE) AS c_acctbal,
  sha256(c_mktsegment) AS c_mktsegment FROM customer""")
def protect_columns(spark: SparkSession, base: str) -> DataFrame:
    plan = [K.Protection("c_name", "tokenized-vault"), K.Protection("c_acctbal", "governed", "MONEY"),
            K.Protection("c_mktsegment", "governed-pushdown", "SEGMENT")]
    return K.protect_columns(D.load(spark, base, "customer"), plan, RULES, "ANALYST", SECRET)[0]


def _sealed(rows: DataFrame, key: str, alphabet: str, is_padded: bool) -> DataFrame:
    """Rows (key, plain, sealed) with what encryption promises: the shape stays, values stay distinct, and come back."""
    symbols = {"numeric": "[0-9]", "alphanumeric": "[0-9A-Za-z]"}[alphabet]
    shape = lambda c: F.regexp_replace(c, symbols, "0")
    pairs = write_through(rows.select("plain", "sealed").distinct(), "pairs")
    keeps = F.endswith(shape("sealed"), shape("plain")) if is_padded else shape("sealed") == shape("plain")
    one_to_one = pairs.groupBy("sealed").agg(F.count(F.lit(1)).alias("values_of_sealed"))
    forms = pairs.groupBy("plain").agg(F.count(F.lit(1)).alias("forms_of_value"))
    judged = pairs.join(one_to_one, "sealed").join(forms, "plain").select(
        "plain", "sealed", fpe_decrypt(F.col("sealed"), alphabet, KEYS, is_padded=is_padded).alias("opened"), keeps.alias("same_shape"),
        (F.col("sealed") != F.col("plain")).alias("moved"), "values_of_sealed", "forms_of_value")
    return rows.join(judged, ["plain", "sealed"]).select(key, "opened", "same_shape", "moved", "values_of_sealed", "forms_of_value")


def _phones(spark: SparkSession, base: str) -> DataFrame:
    return D.load(spark, base, "customer").select("c_custkey", F.format_string("555-%07d", F.col("c_custkey")).alias("plain"))


@query("fpe_encrypt", """
SELECT c_custkey, '555-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS opened, true AS same_shape, true AS moved,
  1 AS values_of_sealed, 1 AS forms_of_value FROM customer""")
def fpe_encrypt_query(spark: SparkSession, base: str) -> DataFrame:
    """Phone numbers: the separator stays, no two meet, all come back; AES itself is not part of the SQL engine."""
    rows = write_through(_phones(spark, base).withColumn("sealed", fpe_encrypt(F.col("plain"), "numeric", KEYS)), "sealed")
    return _sealed(rows, "c_custkey", "numeric", False)


def _sealed_priorities(spark: SparkSession, base: str) -> DataFrame:
    """A column with few different values: each one is encrypted once."""
    rows = D.load(spark, base, "orders").select("o_orderkey", "o_orderpriority")
    return K.encrypt_distinct(rows, "o_orderpriority", "alphanumeric", KEYS, is_padded=True)


@query("fpe_encrypt_distinct", """
SELECT o_orderkey, o_orderpriority AS opened, true AS same_shape, true AS moved, 1 AS values_of_sealed, 1 AS forms_of_value FROM orders""")
def fpe_encrypt_distinct(spark: SparkSession, base: str) -> DataFrame:
    """The same for a column with few values, each encrypted once and padded."""
    sealed = write_through(_sealed_priorities(spark, base), "sealed").select("o_orderkey", F.col("o_orderpriority").alias("sealed"))
    rows = sealed.join(D.load(spark, base, "orders").select("o_orderkey", F.col("o_orderpriority").alias("plain")), "o_orderkey")
    return _sealed(rows, "o_orderkey", "alphanumeric", True)


@query("fpe_long_values", """
SELECT o_orderkey, repeat(lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '-', 7) AS opened, true AS same_shape, true AS moved,
  1 AS values_of_sealed, 1 AS forms_of_value FROM orders""")
def fpe_long_values(spark: SparkSession, base: str) -> DataFrame:
    """Values of 63 digits."""
    plain = F.repeat(F.concat(F.lpad(F.col("o_orderkey").cast("string"), 9, "0"), F.lit("-")), F.lit(7))
    rows = D.load(spark, base, "orders").select("o_orderkey", plain.alias("plain"))
    rows = write_through(rows.withColumn("sealed", fpe_encrypt(F.col("plain"), "numeric", KEYS)), "sealed")
    return _sealed(rows, "o_orderkey", "numeric", False)


@query("fpe_roundtrip", """
SELECT count(*) AS rows, count(*) AS same, count(*) AS same_shape, true AS moved FROM customer""")
def fpe_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    plain = D.load(spark, base, "customer").select(F.format_string("555-%07d", F.col("c_custkey")).alias("p"))
    sealed = plain.withColumn("c", fpe_encrypt(F.col("p"), "numeric", KEYS))
    opened = sealed.withColumn("b", fpe_decrypt(F.col("c"), "numeric", KEYS))
    shape = F.regexp_replace("c", "[0-9]", "0") == F.regexp_replace("p", "[0-9]", "0")
    return opened.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("b") == F.col("p")).alias("same"),
        F.count_if(shape).alias("same_shape"),
        (F.count_if(F.col("c") == F.col("p")) * 100 < F.count(F.lit(1))).alias("moved"))


@query("fpe_roundtrip_distinct", "SELECT o_orderkey, o_orderpriority FROM orders")
def fpe_roundtrip_distinct(spark: SparkSession, base: str) -> DataFrame:
    sealed = write_through(_sealed_priorities(spark, base), "sealed")
    return K.decrypt_distinct(sealed, "o_orderpriority", "alphanumeric", KEYS, is_padded=True)


@query("fpe_padded_roundtrip", """
SELECT o_orderkey, k, v AS plain, v AS opened FROM (
  SELECT o_orderkey, unnest(range(5)) AS k, unnest(['12', '012', CAST(o_orderkey AS VARCHAR), lpad(CAST(o_orderkey AS VARCHAR), 9, '0'),
    'x-' || (o_orderkey % 10) || '/00']) AS v FROM orders)""")
def fpe_padded_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Short values, with and without leading zeros and other characters, come back as they were."""
    number = F.col("o_orderkey").cast("string")
    values = F.array(F.lit("12"), F.lit("012"), number, F.lpad(number, 9, "0"),
                     F.concat(F.lit("x-"), (F.col("o_orderkey") % 10).cast("string"), F.lit("/00")))
    rows = D.load(spark, base, "orders").select("o_orderkey", F.posexplode(values).alias("k", "plain"))
    sealed = K.encrypt_distinct(rows.withColumn("opened", F.col("plain")), "opened", "numeric", KEYS, is_padded=True)
    opened = K.decrypt_distinct(write_through(sealed, "sealed"), "opened", "numeric", KEYS, is_padded=True)
    return opened.withColumn("k", F.col("k").cast("long"))


@query("protect_columns_fpe", """
SELECT c_custkey, c_name AS opened, true AS same_shape, true AS moved FROM customer""")
def protect_columns_fpe(spark: SparkSession, base: str) -> DataFrame:
    """The encrypted branch of the dispatch: letters and the separator stay, digits change, and they come back."""
    rows = D.load(spark, base, "customer").select("c_custkey", "c_name")
    plan = [K.Protection("c_name", "encryption-fpe", versions=tuple(KEYS))]
    sealed, _ = K.protect_columns(rows, plan, RULES, "ANALYST")
    both = write_through(sealed, "sealed").join(rows.withColumnRenamed("c_name", "plain"), "c_custkey")
    return both.select(
        "c_custkey", fpe_decrypt(F.col("c_name"), "numeric", KEYS).alias("opened"),
        (F.regexp_replace("c_name", "[0-9]", "0") == F.regexp_replace("plain", "[0-9]", "0")).alias("same_shape"),
        (F.col("c_name") != F.col("plain")).alias("moved"))
