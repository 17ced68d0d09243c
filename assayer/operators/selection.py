"""Exact-size splits, caps and first-n selections, and seeded permutations.

Selections compare every row with a threshold row. The threshold is found by counting
rows per range of an integer sort code, then per narrower range, until few are left:
each pass reads only the columns it needs and returns at most 4,096 counts, and no pass
sorts, shuffles or collects the rows themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.vocabulary import DEFAULT_SEED, DEFAULT_TEST_SIZE
from ..session import written
from .positions import number_partitions, with_position

_RANGES = 4096
# A range with at most this many rows is sorted as it is, without further narrowing.
_SMALL_RANGE = 1 << 18
# Largest n for which every task keeping its own first n rows is the cheaper way.
_SMALL_LIMIT = 1000
# Hash codes are 60 bits wide, so that range arithmetic on them cannot overflow.
_HASH_DIGITS = 15
_HASH_CODES = (0, 16**_HASH_DIGITS - 1)


def permutation_hash(id_col: str, seed: int) -> Column:
    """Hex digest that orders the rows of a seeded permutation."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _content_code(df: DataFrame) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*sorted(df.columns)), 4)


def permute(df: DataFrame, id_col: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """The rows with their 0-based ``position`` in a seeded pseudo-random order.

    Rows that share an id follow each other in content order. The rows go straight to the
    partitions of their hashes' prefixes, which a count of the prefixes has cut into equal parts,
    are sorted there and written once. Copies of one row that fill partitions of their own are
    dealt out over several: their order among each other is nobody's concern.
    """
    keyed = df.withColumns(
        {"__hash": permutation_hash(id_col, seed), "__content": _content_code(df)}
    )
    prefix = F.substring("__hash", 1, _PREFIX_DIGITS)
    cuts, parts = _permutation_cuts(keyed.select(prefix.alias("__prefix"), "__hash", "__content"))
    named = df.sparkSession.createDataFrame(
        cuts, "__prefix string, __part int, __hot array<struct<hash string, content long, part int, parts int>>"
    )
    # A row per prefix, and at most some copies' rows per partition.
    joined = keyed.withColumn("__prefix", prefix).join(F.broadcast(named), "__prefix")
    own = F.struct(F.col("__hash").alias("hash"), F.col("__content").alias("content"))

    def behind(part: Column, hot: Column) -> Column:
        """The partition of a row: that of the last copies not after it, or the one behind."""
        other = F.struct(hot["hash"].alias("hash"), hot["content"].alias("content"))
        dealt = hot["part"] + F.pmod(F.col("__copy"), hot["parts"]).cast("int")
        return F.when(other == own, dealt).when(other < own, hot["part"] + hot["parts"]).otherwise(part)

    part = F.aggregate("__hot", F.col("__part"), behind)
    placed = (
        joined.withColumn("__copy", F.monotonically_increasing_id())
        .withColumn("__to", part)
        .select(*df.columns, "__hash", "__content", "__to")
        .repartitionById(parts, "__to")
        .sortWithinPartitions("__hash", "__content")
    )
    return number_partitions(placed.drop("__hash", "__content", "__to"))


#: Hex digits of a prefix of the hash: 65,536 counts come to the driver.
_PREFIX_DIGITS = 4


def _permutation_cuts(keys: DataFrame) -> tuple[list[tuple], int]:
    """Per prefix of the hash the partition where its rows begin, and the copies in it that have
    partitions of their own, in order; and the number of partitions."""
    counts = dict(keys.groupBy("__prefix").count().collect())
    wanted = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    target = max(1, -(-sum(counts.values()) // wanted))
    hot: dict[str, list] = {}
    large = [prefix for prefix, n in counts.items() if n > target]
    if large:
        copies = (
            keys.where(F.col("__prefix").isin(large))
            .groupBy("__hash", "__content")
            .count()
            .where(F.col("count") > target)
        )
        for row in copies.collect():  # fewer than partitions are wanted
            hot.setdefault(row["__hash"][:_PREFIX_DIGITS], []).append(tuple(row))
    cuts, part, filled = [], 0, 0
    for prefix in sorted(counts):
        rest = counts[prefix] - sum(n for _, _, n in hot.get(prefix, []))
        if filled and filled + rest > target:
            part, filled = part + 1, 0
        start, own = part, []
        filled += rest
        for digest, content, n in sorted(hot.get(prefix, [])):
            parts = -(-n // target)
            own.append((digest, content, part + 1, parts))
            part, filled = part + 1 + parts, 0
        cuts.append((prefix, start, own))
    return cuts, part + 1


@dataclass(frozen=True)
class _Code:
    """An integer sort code between ``low`` and ``high``, in an integer column."""

    column: Column
    low: int
    high: int

    def value(self, code: int) -> int | str:
        return code

    def range_of(self, name: str, low: int, width: int) -> Column:
        """The number of a code's range, counting ranges of ``width`` from ``low``."""
        return F.expr(f"({name} - {low}L) DIV {width}L")

    def range_number(self, label: int | str, low: int, width: int) -> int:
        return label


class _HexCode(_Code):
    """A hash code in a column of 15 hex digits, which sort like the number.

    Ranges are made by powers of 16, so a range is a prefix and no digits are converted.
    """

    def value(self, code: int) -> int | str:
        return f"{code:0{_HASH_DIGITS}x}"

    def range_of(self, name: str, low: int, width: int) -> Column:
        return F.substring(name, 1, len(self._prefix(low, width)))

    def range_number(self, label: int | str, low: int, width: int) -> int:
        return int(label, 16) - int(self._prefix(low, width), 16)

    def _prefix(self, low: int, width: int) -> str:
        dropped = (width.bit_length() - 1) // 4
        return self.value(low)[: _HASH_DIGITS - dropped]


@dataclass(frozen=True)
class _Order:
    """Total order of rows: an integer code, then a hash code of the row's content, then
    the content's digest. Rows equal in all three are identical, so a selection need
    not know which of them it takes, only how many.
    """

    code: _Code
    content_code: _Code
    digest: Column

    @staticmethod
    def by(df: DataFrame, code: _Code) -> _Order:
        row = F.struct(*[F.col(c) for c in sorted(df.columns)])
        digest = F.md5(F.to_json(row, {"ignoreNullFields": "false"}))
        return _Order(code, _Code(_content_code(df), *_HASH_CODES), digest)


@dataclass(frozen=True)
class _Threshold:
    """The k-th row in the order; ``taken`` of its ``copies`` are among the first k."""

    values: tuple
    taken: int
    copies: int


def _range_counts(
    rows: DataFrame, code: _Code, low: int, high: int
) -> tuple[int, list[int]]:
    """Width of, and rows in, each of up to 4,096 equal ranges of ``code``."""
    width = -(-(high - low + 1) // _RANGES)
    counts = [0] * _RANGES
    found = (
        rows.select(code.column.alias("code"))
        .where(F.col("code").between(code.value(low), code.value(high)))
        .groupBy(code.range_of("code", low, width).alias("range"))
        .count()
        .collect()
    )
    for row in found:
        counts[code.range_number(row["range"], low, width)] = row["count"]
    return width, counts


def _narrow(
    rows: DataFrame, code: _Code, rank: int, first: tuple[int, list[int]] | None = None
) -> tuple[DataFrame, int, int]:
    """The rows of a small range, or of one code, that holds the ``rank``-th row.

    Returns them with the rank among them, and their number.
    """
    low, high = code.low, code.high
    width, counts = first or _range_counts(rows, code, low, high)
    while True:
        i = 0
        while rank > counts[i]:
            rank -= counts[i]
            i += 1
        low, high = low + i * width, min(high, low + (i + 1) * width - 1)
        if counts[i] <= _SMALL_RANGE or low == high:
            kept = rows.where(code.column.between(code.value(low), code.value(high)))
            return kept, rank, counts[i]
        width, counts = _range_counts(rows, code, low, high)


def _threshold(df: DataFrame, order: _Order, first: tuple[int, list[int]], k: int) -> _Threshold:
    rows, rank, n = _narrow(df, order.code, k, first)
    if n > _SMALL_RANGE:
        # One code, such as that of a missing id, on many rows: go on by content.
        rows, rank, n = _narrow(rows, order.content_code, rank)
    # Copies are counted before the window, so a large group of them is one row here.
    names = ["code", "content_code", "digest"]
    row = (
        rows.select(
            order.code.column.alias("code"),
            order.content_code.column.alias("content_code"),
            order.digest.alias("digest"),
        )
        .groupBy(*names)
        .agg(F.count("*").alias("copies"))
        .withColumn("upto", F.sum("copies").over(Window.orderBy(*names)))
        .where(F.col("upto") >= rank)
        .orderBy("upto")
        .first()
    )
    taken = rank - (row["upto"] - row["copies"])
    return _Threshold(tuple(row[n] for n in names), taken, row["copies"])


def _compare(order: _Order, threshold: _Threshold) -> tuple[Column, Column]:
    """Conditions for rows before the threshold row, and for its copies.

    The content is only hashed on rows whose code equals the threshold's.
    """
    fields = (order.code.column, order.content_code.column, order.digest)
    before, same = F.lit(False), F.lit(True)
    for field, value in zip(fields, threshold.values):
        before = before | (same & (field < value))
        same = same & (field == value)
    return before, same


def _repeat(row: DataFrame, times: int) -> DataFrame:
    """``times`` copies of a one-row frame, made in parallel."""
    block = 1_000_000
    starts = F.sequence(F.lit(0), F.lit(times - 1).cast("bigint"), F.lit(block))
    blocks = row.withColumn("__start", F.explode(starts))
    if times > block:
        blocks = blocks.repartition("__start")
    end = F.least(F.col("__start") + block - 1, F.lit(times - 1))
    return blocks.withColumn("__i", F.explode(F.sequence("__start", end))).drop("__start", "__i")


def _first(df: DataFrame, order: _Order, threshold: _Threshold) -> DataFrame:
    before, same = _compare(order, threshold)
    if threshold.taken == threshold.copies:
        return df.where(before | same)
    return df.where(before).union(_repeat(df.where(same).limit(1), threshold.taken))


def _rest(df: DataFrame, order: _Order, threshold: _Threshold) -> DataFrame:
    before, same = _compare(order, threshold)
    after = df.where(~(before | same))
    left = threshold.copies - threshold.taken
    return after.union(_repeat(df.where(same).limit(1), left)) if left else after


def _checked_cap(n: int | None) -> int | None:
    if n is not None and n < 0:
        raise ValueError("a cap must not be negative")
    return n


def train_test_split(
    df: DataFrame,
    id_col: str = "id",
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    max_train: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Exact-size seeded split; train gets the first ``int(n * (1 - test_size))`` rows.

    ``max_train`` (0 or None: no cap) keeps only the first rows of train; test is the
    full remainder either way. The counting passes run when this is called, so ``df``
    should be a table or another source that yields the same rows each time.
    """
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must be between 0 and 1")
    _checked_cap(max_train)
    prefix = F.substring(permutation_hash(id_col, seed), 1, _HASH_DIGITS)
    order = _Order.by(df, _HexCode(prefix, *_HASH_CODES))
    first = _range_counts(df, order.code, *_HASH_CODES)
    total = sum(first[1])
    n_train = int(total * (1 - test_size))
    n_kept = min(max_train or n_train, n_train)
    cuts = {
        k: _threshold(df, order, first, k)
        for k in {n_train, n_kept}
        if 0 < k < total
    }

    nothing = df.limit(0)
    if n_kept in cuts:
        train = _first(df, order, cuts[n_kept])
    else:
        train = df if n_kept else nothing
    if n_train in cuts:
        test = _rest(df, order, cuts[n_train])
    else:
        test = nothing if n_train else df
    return train, test


def _first_numbered(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    ordered = df.withColumn("__content", _content_code(df))
    placed = with_position(ordered, [*columns, "__content"], "__at")
    return placed.where(F.col("__at") < n).drop("__at", "__content")


def exactly_first_rows(df: DataFrame, order_by: str | Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order_by``, or all if there are fewer; 0 means none.

    One order at every ``n``: missing keys first, and equal keys by a hash of the row's
    content. For a large ``n`` and a single integer column the result is a range filter on
    it, which reaches the table scan. Other orders are numbered.
    """
    columns = [order_by] if isinstance(order_by, str) else list(order_by)
    if _checked_cap(n) <= _SMALL_LIMIT:
        return df.orderBy(*columns, _content_code(df)).limit(n)
    if len(columns) > 1 or not isinstance(df.schema[columns[0]].dataType, IntegralType):
        return _first_numbered(df, columns, n)
    key = F.col(columns[0])
    low, high, missing = df.agg(F.min(key), F.max(key), F.count_if(key.isNull())).first()
    without, known = df.where(key.isNull()), df.where(key.isNotNull())
    if n <= missing:
        order = _Order.by(df, _Code(F.lit(0).cast("bigint"), 0, 0))
        first = _range_counts(without, order.code, 0, 0)
        return _first(without, order, _threshold(without, order, first, n))
    if low is None:
        return df
    if high - low >= 1 << 63:
        return _first_numbered(df, columns, n)  # differences would overflow
    order = _Order.by(df, _Code(key.cast("bigint"), low, high))
    first = _range_counts(known, order.code, low, high)
    if n - missing >= sum(first[1]):
        return df
    threshold = _threshold(known, order, first, n - missing)
    found = _first(known.where(key <= threshold.values[0]), order, threshold)
    return without.union(found) if missing else found


def quota_sample(
    df: DataFrame,
    column: str,
    quotas: Mapping[str, int],
    id_col: str = "id",
    seed: int = DEFAULT_SEED,
    short: str = "fewer",
) -> DataFrame:
    """The first rows of each group in a seeded order: as many as its quota.

    A group with fewer rows gives all it has (``short="fewer"``), is an error (``"error"``), or
    is drawn from again (``"repeat"``): each row equally often, and the first rows of the order
    once more. A group without rows cannot be drawn from and is an error then, too.

    However many groups there are, one pass counts them all by ranges of the hash, and one filter
    by a row per quota, which is broadcast, keeps what lies before each group's last range. Only
    the rows of those ranges are ordered, some 4,096th of a group, if ids are not repeated.
    """
    if short not in ("fewer", "error", "repeat"):
        raise ValueError(f"unknown way {short!r} with a short group")
    wanted = [(value, _checked_cap(n)) for value, n in quotas.items() if n]
    if not wanted:
        return df.limit(0)
    kind = df.schema[column].dataType.simpleString()
    spark = df.sparkSession
    marks = _quota_marks(df, column, wanted, kind, id_col, seed, short)
    named = spark.createDataFrame(marks, f"__group {kind}, __full long, __last string, __rest long")
    # A row per quota, and quotas are given by the caller.
    own = F.col(column) == F.col("__group")
    keyed = df.withColumn("__hash", permutation_hash(id_col, seed)).join(F.broadcast(named), own)
    prefix = F.substring("__hash", 1, _QUOTA_DIGITS)
    times = F.col("__full") + F.coalesce(prefix < F.col("__last"), F.lit(False)).cast("long")
    whole = keyed.where(times > 0)
    if short == "repeat":
        whole = whole.withColumn("__time", F.explode(F.sequence(F.lit(1), times)))
    kept = whole.select(*df.columns)
    if any(rest for *_, rest in marks):
        edge = written(
            keyed.where(prefix == F.col("__last")).withColumns(
                {"__content": _content_code(df), "__copy": F.monotonically_increasing_id()}
            ),
            "quota-edges",
        )
        placed = with_position(edge, ["__group", "__hash", "__content", "__copy"], "__at")
        first = placed.groupBy(F.col("__group").alias("__own")).agg(F.min("__at").alias("__first"))
        placed = placed.join(F.broadcast(first), F.col("__group") == F.col("__own"))
        inside = F.col("__at") - F.col("__first") < F.col("__rest")
        kept = kept.union(placed.where(inside).select(*df.columns))
    return kept


#: Hex digits of the hash that make a range.
_QUOTA_DIGITS = 3


def _quota_marks(
    df: DataFrame, column: str, wanted: list[tuple], kind: str, id_col: str, seed: int, short: str
) -> list[tuple]:
    """Per group: how often all its rows are taken, the range in which the rest ends, and how many
    rows of that range belong to it."""
    quotas = df.sparkSession.createDataFrame(wanted, f"__group {kind}, __n long")
    prefix = F.substring(permutation_hash(id_col, seed), 1, _QUOTA_DIGITS)
    counts = (
        df.select(F.col(column).alias("__group"), prefix.alias("__range"))
        .join(F.broadcast(quotas), "__group")
        .groupBy("__group", "__n", "__range")
        .agg(F.count("*").alias("__count"))
    )
    group = Window.partitionBy("__group")  # at most a row per range
    so_far = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.select(
        "*", F.sum("__count").over(group).alias("__all"), F.sum("__count").over(so_far).alias("__to")
    )
    full = F.expr("__n DIV __all") if short == "repeat" else (F.col("__n") >= F.col("__all")).cast("long")
    rest = F.when((F.lit(short) == "repeat") | (full == 0), F.col("__n") - full * F.col("__all"))
    before = F.col("__to") - F.col("__count")
    ends = summed.withColumns({"__full": full, "__left": F.coalesce(rest, F.lit(0))}).groupBy("__group").agg(
        F.max("__all").alias("all"),
        F.max("__full").alias("full"),
        F.max(F.when((F.col("__left") > before) & (F.col("__left") <= F.col("__to")),
                     F.struct("__range", (F.col("__left") - before).alias("rest")))).alias("end"),
    )
    found = {row["__group"]: row for row in ends.collect()}  # a row per quota
    marks = []
    for value, n in wanted:
        row = found.get(value)
        if short != "fewer" and (row is None or (short == "error" and row["all"] < n)):
            raise ValueError(f"{value!r} has {row['all'] if row else 0} of the {n} rows asked for")
        if row is not None:
            end = row["end"]
            marks.append((value, row["full"], end["__range"] if end else None, end["rest"] if end else 0))
    return marks


def weighted_mixture(
    df: DataFrame,
    column: str,
    weights: Mapping[str, float],
    n: int,
    id_col: str = "id",
    seed: int = DEFAULT_SEED,
    short: str = "error",
) -> DataFrame:
    """``n`` rows whose sources in ``column`` have shares by weight.

    What is left after rounding down goes to the largest remainders, in the order given. A
    source with too few rows is an error, unless ``short`` says what else to do, see
    ``quota_sample``; with ``"repeat"`` there are always ``n`` rows in the shares asked for.
    """
    if not weights or min(weights.values()) < 0 or not sum(weights.values()):
        raise ValueError("weights must not be negative, nor all zero")
    total = sum(weights.values())
    shares = {source: _checked_cap(n) * w / total for source, w in weights.items()}
    quotas = {source: int(share) for source, share in shares.items()}
    by_rest = sorted(shares, key=lambda source: quotas[source] - shares[source])
    for source in by_rest[: n - sum(quotas.values())]:
        quotas[source] += 1
    return quota_sample(df, column, quotas, id_col, seed, short)


def balanced_sample(
    df: DataFrame,
    column: str,
    classes: Sequence[str],
    n: int | None = None,
    id_col: str = "id",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The same number of rows of each class: ``n``, or as many as the rarest has."""
    if n is None:
        rows = df.where(F.col(column).isin(*classes)).groupBy(column).count().collect()
        counts = {r[0]: r[1] for r in rows}
        n = min(counts.get(c, 0) for c in classes)
    return quota_sample(df, column, dict.fromkeys(classes, n), id_col, seed)


def first_rows(df: DataFrame, order_by: str | Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows by ``order_by``; 0 or None keeps all rows."""
    return exactly_first_rows(df, order_by, n) if _checked_cap(n) else df
