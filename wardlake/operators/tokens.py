"""Tokenization against a vault, and protection dispatch.

A token is a keyed hash, so it can be computed where the value stands: tokenizing
a table needs no join with the vault, and a task that is run again after a lost
executor yields the same token. Only values whose token was deleted before need
a lookup, for their generation number.
"""

from __future__ import annotations

import hashlib
import hmac
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.functions.fpe import KeyVersion, fpe_decrypt, fpe_encrypt
from wardlake.operators.masking import MaskRule, levels_for_role, project_levels
from wardlake.operators.scaling import number_rows, skew_join
from wardlake.session import write_through


@dataclass(frozen=True)
class TokenKind:
    """Prefixes and limits of one token service."""

    deterministic_prefix: str
    random_prefix: str
    max_per_call: int
    max_size: int
    size_in_bytes: bool

    def size(self, col: Column) -> Column:
        return F.octet_length(col) if self.size_in_bytes else F.char_length(col)


# Token prefixes and limits of the two services.
KINDS = {
    "vault": TokenKind("vaultd_", "vaultn_", 4096, 1024, False),
    "critical": TokenKind("token_", "token_", 1024, 128, True),
}
VAULT_DDL = "token string, value string, kind string, deterministic boolean, generation int"
RETIRED_DDL = "value_hash string, kind string, generation int"


def derived_keys(secret: str) -> tuple[str, str]:
    """Inner and outer key of the token hash. Plans carry these, never the secret."""
    if not secret:
        raise ValueError("tokens need a secret")
    inner, outer = (hmac.new(secret.encode(), use, hashlib.sha256).hexdigest() for use in (b"inner", b"outer"))
    return inner, outer


def _keyed_hash(secret: str, message: Column) -> Column:
    """A hash inside a hash with two keys, as HMAC does."""
    inner, outer = derived_keys(secret)
    return F.sha2(F.concat(F.lit(outer), F.sha2(F.concat(F.lit(inner), message), 256)), 256)


def _part(value: Column) -> Column:
    """A part of a key that cannot run into the next one: its length first; null differs from every text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def deterministic_token(value: Column, kind: str, secret: str, generation: Column | None = None) -> Column:
    """Same value and generation, same token."""
    gen = F.lit("0") if generation is None else generation.cast("string")
    prefix = KINDS[kind].deterministic_prefix
    return F.when(value.isNotNull(),
                  F.concat(F.lit(prefix), _keyed_hash(secret, F.concat(F.lit("d|"), gen, F.lit("|"), value.cast("string")))))


def random_token(value: Column, kind: str, secret: str, call: str, row_key: Sequence[str],
                 column: str | Column) -> Column:
    """A token per cell and call: the nonce of the call and the row key make it new.

    Unlike ``uuid()`` it comes out the same when a task is retried.
    """
    name = F.lit(column) if isinstance(column, str) else column
    cell = F.concat(F.lit("n|"), *[_part(p) for p in (F.lit(call), name, *[F.col(k) for k in row_key])])
    prefix = KINDS[kind].random_prefix
    return F.when(value.isNotNull(),
                  F.concat(F.lit(prefix), _keyed_hash(secret, cell)))


def too_large(col: Column, kind: str) -> Column:
    return KINDS[kind].size(col) >= KINDS[kind].max_size


def _guard(col: Column, kind: str, strict: bool) -> Column:
    """The value; where the limits are strict, a failed job when it reaches the size limit."""
    if not strict:
        return col
    k = KINDS[kind]
    unit = "bytes" if k.size_in_bytes else "characters"
    message = F.lit(f"value reaches the {kind} limit of {k.max_size} {unit}")
    return F.when(too_large(col, kind), F.raise_error(message).cast("string")).otherwise(col)


def tokenize(
    df: DataFrame, cols: Sequence[str], kind: str = "vault", deterministic: bool = True, *,
    secret: str, retired: DataFrame | None = None, row_key: Sequence[str] | None = None,
    call: str | None = None, strict_size: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The table with tokens in place of values, and the vault rows they need.

    ``retired`` holds generation numbers of values whose tokens were deleted.
    Random tokens need a unique ``row_key``. ``strict_size`` fails the job at a
    value that reaches the service's size limit; ``check_limits`` lists such values.
    """
    if deterministic:
        return _tokenize_deterministic(df, cols, kind, secret, retired, strict_size)
    if not row_key:
        raise ValueError("random tokens need the key columns of the table")
    nonce = call or uuid.uuid4().hex
    marked = df.withColumns({
        f"_token_{c}": random_token(_guard(F.col(c), kind, strict_size), kind, secret, nonce, row_key, c) for c in cols
    })
    return _replace(df, marked, cols), _pairs(marked, cols, kind, False, {c: F.lit(0) for c in cols})


def _generations(retired: DataFrame, kind: str) -> DataFrame:
    """The latest generation of each deleted value of a kind."""
    return retired.filter(F.col("kind") == kind).groupBy("value_hash").agg(F.max("generation").alias("generation"))


def _tokenize_deterministic(df, cols, kind, secret, retired, strict_size):
    marked, generations = df, {c: F.lit(0) for c in cols}
    if retired is not None:
        known = _generations(retired, kind)
        for c in cols:
            looked_up = known.select(F.col("value_hash").alias(f"_hash_{c}"),
                                     F.col("generation").alias(f"_gen_{c}"))
            hashed = marked.withColumn(f"_hash_{c}", F.sha2(F.col(c).cast("string"), 256))
            marked = hashed.join(looked_up, f"_hash_{c}", "left")
            generations[c] = F.coalesce(f"_gen_{c}", F.lit(0))
    marked = marked.withColumns({
        f"_token_{c}": deterministic_token(_guard(F.col(c), kind, strict_size), kind, secret, generations[c]) for c in cols
    })
    return _replace(df, marked, cols), _pairs(marked, cols, kind, True, generations)


def _replace(df: DataFrame, marked: DataFrame, cols: Sequence[str]) -> DataFrame:
    return marked.select(*[F.col(f"_token_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def _pairs(marked: DataFrame, cols: Sequence[str], kind: str, deterministic: bool,
           generations: Mapping[str, Column]) -> DataFrame:
    """Vault rows of the tokens; repeated deterministic ones shrink before the shuffle."""
    cells = F.explode(F.array(*[
        F.struct(F.col(f"_token_{c}").alias("token"), F.col(c).cast("string").alias("value"),
                 generations[c].cast("int").alias("generation"))
        for c in cols
    ])).alias("cell")
    rows = marked.select(cells).select("cell.*").filter(F.col("token").isNotNull())
    if deterministic:
        rows = rows.distinct()
    return rows.select("token", "value", F.lit(kind).alias("kind"),
                       F.lit(deterministic).alias("deterministic"), "generation")


def vault_tokenize(df: DataFrame, cols: Sequence[str], vault: DataFrame | None = None, kind: str = "vault",
                   deterministic: bool = True, **options) -> tuple[DataFrame, DataFrame]:
    """Tokenize and return the grown vault; a token already stored is not added again."""
    out, pairs = tokenize(df, cols, kind, deterministic, **options)
    if vault is None:
        return out, pairs
    fresh = pairs.join(vault.select("token"), "token", "left_anti")
    return out, vault.unionByName(fresh)


def critical_tokenize(df: DataFrame, cols: Sequence[str], vault: DataFrame | None = None,
                      deterministic: bool = True, **options) -> tuple[DataFrame, DataFrame]:
    return vault_tokenize(df, cols, vault, "critical", deterministic, **options)


#: Vaults of up to so many tokens are broadcast; a token and its value take about a kilobyte at most.
VAULT_ROWS = 20_000


def _resolve(df: DataFrame, cols: Sequence[str], vault: DataFrame, strict: bool, kind: str | None) -> DataFrame:
    """Look up the tokens of all columns in a vault that is reduced to one row per token once.

    A pair that is stored twice does not double rows. A vault of up to ``VAULT_ROWS``
    tokens, counted, is sent to the rows. Beyond, one column is a plain join, whose hot
    tokens adaptive execution splits; the cells of several columns are looked up
    together and put back by a row number: the cells move twice and the rows once,
    whatever the number of columns.
    """
    mine = vault if kind is None else vault.filter(F.col("kind") == kind)
    single = mine.groupBy("token").agg(F.max("value").alias("_plain"))

    def value(token: Column, plain: Column) -> Column:
        if not strict:
            return F.coalesce(plain, token)
        missing = F.raise_error(F.concat(F.lit("not a valid token: "), token)).cast("string")
        return F.when(token.isNotNull() & plain.isNull(), missing).otherwise(plain)

    small = mine.select("token").distinct().limit(VAULT_ROWS + 1).count() <= VAULT_ROWS
    if small:
        single = F.broadcast(write_through(single, "vault"))
    if small or len(cols) == 1:
        out = df
        for c in cols:
            joined = out.join(single.withColumnRenamed("token", c), c, "left")
            out = joined.withColumn(c, value(F.col(c), F.col("_plain"))).select(*df.columns)
        return out
    rows = write_through(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    cells = rows.select("_row", F.posexplode(F.array(*cols)).alias("_column", "token")).where("token IS NOT NULL")
    found = cells.join(single, "token").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_column", "_plain"))).alias("_found"))
    plain = lambda i: F.element_at("_found", F.lit(i))
    return rows.join(found, "_row", "left").select(*[
        value(F.col(c), plain(list(cols).index(c))).alias(c) if c in cols else F.col(c) for c in df.columns])


def detokenize(df: DataFrame, cols: Sequence[str], vault: DataFrame, kind: str | None = None) -> DataFrame:
    """Recover the values; one invalid token fails the job. Case-sensitive. ``kind`` admits one service's tokens only."""
    return _resolve(df, cols, vault, True, kind)


def partial_detokenize(df: DataFrame, cols: Sequence[str], vault: DataFrame, kind: str | None = None) -> DataFrame:
    """Recover valid tokens; everything else passes."""
    return _resolve(df, cols, vault, False, kind)


def delete_tokens(vault: DataFrame, tokens: DataFrame, kind: str,
                  retired: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The vault without the tokens, the new generation numbers, and unknown tokens.

    Unknown tokens are reported for the vault service and ignored for the critical
    one. Only a hash of a deleted value remains, with its next generation.
    """
    asked = tokens.select("token").distinct()
    mine = vault.filter(F.col("kind") == kind)
    doomed = mine.join(asked, "token", "left_semi")
    left = vault.join(doomed.select("token", "kind"), ["token", "kind"], "left_anti")
    gone = doomed.filter("deterministic").select(
        F.sha2("value", 256).alias("value_hash"), "kind", (F.col("generation") + 1).alias("generation"))
    if retired is not None:
        gone = retired.unionByName(gone)
    gone = gone.groupBy("value_hash", "kind").agg(F.max("generation").alias("generation"))
    unknown = asked.join(mine.select("token"), "token", "left_anti")
    return left, gone, unknown if kind == "vault" else unknown.limit(0)


def tokenize_map(df: DataFrame, map_col: str, kind: str = "vault", deterministic: bool = True, *, secret: str,
                 row_key: Sequence[str] | None = None, call: str | None = None, retired: DataFrame | None = None,
                 strict_size: bool = False) -> tuple[DataFrame, DataFrame]:
    """Tokenize the values of a map column; keys and their order stay.

    The tokens are computed inside the row, so the map is never taken apart and
    put together by a shuffle, unless ``retired`` says that some values had their
    token deleted: then the entries look up their generation and are regrouped by
    ``row_key``. Random tokens need a unique ``row_key`` too; the map key tells the
    cells of a row apart.
    """
    if (not deterministic or retired is not None) and not row_key:
        raise ValueError("random tokens and generations need the key columns of the table")
    nonce = call or uuid.uuid4().hex

    def token(key: Column, value: Column, generation: Column | None = None) -> Column:
        value = _guard(value, kind, strict_size)
        if deterministic:
            return deterministic_token(value, kind, secret, generation)
        return random_token(value, kind, secret, nonce, row_key, key)

    cells = df.select(*(row_key or []), F.posexplode(F.map_entries(map_col)).alias("n", "e")).select(
        *(row_key or []), "n", F.col("e.key").alias("k"), F.col("e.value").cast("string").alias("v"))
    generation = F.lit(0)
    if deterministic and retired is not None:
        known = _generations(retired, kind)
        cells = cells.withColumn("value_hash", F.sha2("v", 256)).join(known, "value_hash", "left").drop("value_hash")
        generation = F.coalesce("generation", F.lit(0))
        out = _regroup(df, map_col, cells.withColumn("v", token(F.col("k"), F.col("v"), generation)), row_key)
    else:
        out = df.withColumn(map_col, F.map_from_entries(F.transform(F.map_entries(map_col), lambda e: F.struct(
            e["key"].alias("key"), token(e["key"], e["value"]).alias("value")))))
    pairs = cells.filter(F.col("v").isNotNull()).select(
        token(F.col("k"), F.col("v"), generation).alias("token"), F.col("v").alias("value"),
        F.lit(kind).alias("kind"), F.lit(deterministic).alias("deterministic"), generation.cast("int").alias("generation"))
    return out, pairs.distinct() if deterministic else pairs


def _regroup(df: DataFrame, map_col: str, cells: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """The table with the map made of ``n``, ``k``, ``v`` cells; the entries of one row are few."""
    maps = cells.groupBy(*row_key).agg(
        F.sort_array(F.collect_list(F.struct("n", "k", "v"))).alias("_e")
    ).select(*row_key, F.map_from_entries(
        F.transform("_e", lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))).alias("_m"))
    return (
        df.join(maps, list(row_key), "left")
        .withColumn(map_col, F.coalesce("_m", map_col)).select(*df.columns)
    )


def detokenize_map(df: DataFrame, map_col: str, vault: DataFrame, row_key: Sequence[str], kind: str | None = None) -> DataFrame:
    """Values of a map column back to plain text; what is no token passes."""
    cells = df.select(*row_key, F.posexplode(F.map_entries(map_col)).alias("n", "e")).select(
        *row_key, "n", F.col("e.key").alias("k"), F.col("e.value").alias("v"))
    return _regroup(df, map_col, partial_detokenize(cells, ["v"], vault, kind), row_key)


def call_batches(df: DataFrame, order: Sequence[str], kind: str) -> DataFrame:
    """Rows with the number of the call they would go into, full calls first."""
    numbered = number_rows(df, [F.asc(c) for c in order], "_row")
    size = KINDS[kind].max_per_call
    return numbered.withColumn("batch", F.floor((F.col("_row") - 1) / size)).drop("_row")


def check_limits(df: DataFrame, cols: Sequence[str], kind: str, batch: str | None = None) -> DataFrame:
    """Violations per column: values that are too large, and per call too many values."""
    k = KINDS[kind]
    cells = df.select(
        *([batch] if batch else []),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
        ])).alias("cell"),
    ).select(*([batch] if batch else []), "cell.*").filter(F.col("value").isNotNull())
    sizes = (
        cells.filter(too_large(F.col("value"), kind)).groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("found"))
        .select("column_name", F.lit("value_size").alias("limit_name"),
                F.lit(None).cast("string").alias("batch"), "found",
                F.lit(k.max_size).alias("allowed"))
    )
    if batch is None:
        return sizes
    counts = (
        cells.groupBy("column_name", F.col(batch).cast("string").alias("batch"))
        .agg(F.count(F.lit(1)).alias("found")).filter(F.col("found") > k.max_per_call)
        .select("column_name", F.lit("values_per_call").alias("limit_name"), "batch", "found",
                F.lit(k.max_per_call).alias("allowed"))
    )
    return sizes.unionByName(counts)


def map_distinct(df: DataFrame, column: str, change: Callable[[Column], Column]) -> DataFrame:
    """Apply a costly function of one text column once per distinct value.

    Values shrink to distinct ones before the shuffle, are changed in parallel and
    joined back, with frequent values spread. Pays off where values repeat; for
    mostly unique values the plain projection moves less data.
    """
    # A fixed partition number keeps adaptive execution from merging this small but
    # costly table into few tasks.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(column).filter(F.col(column).isNotNull()).distinct().repartition(tasks, column)
    changed = values.select(column, change(F.col(column)).alias("_changed"))
    return skew_join(df, changed, [column], "left").select(*[
        F.col("_changed").alias(c) if c == column else F.col(c) for c in df.columns
    ])


def encrypt_distinct(df: DataFrame, column: str, alphabet: str, versions: Sequence[KeyVersion],
                     sequence: int | None = None, is_padded: bool = False) -> DataFrame:
    """Format-preserving encryption with one cipher run per distinct value."""
    return map_distinct(
        df, column, lambda c: fpe_encrypt(c, alphabet, list(versions), sequence, is_padded))


def decrypt_distinct(df: DataFrame, column: str, alphabet: str, versions: Sequence[KeyVersion],
                     sequence: int | None = None, is_padded: bool = False) -> DataFrame:
    return map_distinct(df, column, lambda c: fpe_decrypt(c, alphabet, list(versions), sequence, is_padded))


@dataclass(frozen=True)
class Protection:
    """How one column is protected."""

    column: str
    protection_type: str
    tag_value: str = ""
    alphabet: str = "numeric"
    is_padded: bool = False
    versions: tuple[KeyVersion, ...] = ()


# Protection types of a tag.
PROTECTION_TYPES = ("governed", "governed-pushdown", "tokenized-vault", "encryption-fpe")


def protect_columns(df: DataFrame, protections: Sequence[Protection], rules: Sequence[MaskRule], role: str,
                    secret: str | None = None, retired: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Each column by its protection type, in one projection; vault rows when tokenized.

    Tokenized columns need a ``secret``; ``retired`` gives values whose token was
    deleted a new one.
    """
    wrong = [p.protection_type for p in protections if p.protection_type not in PROTECTION_TYPES]
    if wrong:
        raise ValueError(f"unknown protection types {wrong}")
    governed = {p.column: p.tag_value for p in protections if p.protection_type.startswith("governed")}
    out, pairs = df, None
    tokenized = [p.column for p in protections if p.protection_type == "tokenized-vault"]
    if tokenized:
        out, pairs = tokenize(out, tokenized, "vault", True, secret=secret or "", retired=retired)
    sealed = {p.column: p for p in protections if p.protection_type == "encryption-fpe"}
    if sealed:
        out = out.withColumns({
            c: fpe_encrypt(F.col(c).cast("string"), p.alphabet, list(p.versions), is_padded=p.is_padded)
            for c, p in sealed.items()
        })
    if governed:
        out = project_levels(out, levels_for_role(governed, rules, role))
    return out, pairs

