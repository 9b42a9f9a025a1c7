"""Column profiles: counts, lengths, inferred type, sequences, codes, business category."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keyscout import defaults
from keyscout.functions import moments, patterns, words
from keyscout.functions.text import as_text, col, counted_as, is_minus_zero, normalize
from keyscout.operators.histogram import FIELD, long_values
from keyscout.session import settled
from keyscout.sources.tables import Tables, usable_columns

LONG_VALUE = 64  # longer values travel as their SHA-256 digest

PROFILE_COLUMNS = [
    "sys_code", "table_code", "col_num", "col_code", "records", "distinct", "max_len", "min_len",
    "avg_len", "median_len", "var_len", "skew_len", "kurt_len", "has_chinese", "nullable",
    "default_value", "fixed_length", "autoincrement", "data_type", "data_type_rate", "col_type",
    "tech_cate", "col_pk",
]


def _field_numbers(tables: Tables) -> list[tuple[str, str, int, str]]:
    """All usable fields as ``(sys_code, table_code, col_num, col_code)``; the index is the id."""
    return [
        (*key, i, c) for key, df in tables.items() for i, c in enumerate(usable_columns(df), start=1)
    ]


def _fields(tables: Tables) -> list[tuple[str, DataFrame, str, str]]:
    """Id, table, name and type to count in of all usable fields; the ids are those of ``_field_numbers``."""
    named = [(df, c) for df in tables.values() for c in usable_columns(df)]
    return [(str(i), df, c, counted_as(df.schema[c].dataType)) for i, (df, c) in enumerate(named)]


def _measured(field: str, counted: DataFrame, text: Column, number: Column | None = None) -> DataFrame:
    """Counted values of a field with the measures of their texts."""
    v = F.col("text")
    return counted.select("n", "value", text.alias("text")).select(
        F.lit(field).alias("field"),
        "n",
        F.lit(1).cast("long").alias("values"),
        F.length(v).alias("len"),
        patterns.value_marks(v).alias("marks"),
        (patterns.to_double(v) if number is None else number).alias("number"),
    )


def _measured_texts(field: str, values: DataFrame) -> list[DataFrame]:
    """Counted texts with their measures, short and long ones apart.

    Long texts are identified by their digest, so megabytes of prose do not cross the network; what their profile
    needs is measured before the shuffle and travels behind the digest. They are read apart from the short ones, since
    the code that measures and counts in one step is too long for the JVM to compile.
    """
    v, n = F.col("value"), F.count(F.lit(1)).alias("n")
    packed = F.concat_ws(
        "|", F.sha2(v, 256), F.length(v), patterns.value_marks(v), patterns.to_double(v).cast("string")
    )
    is_long = F.length(v) > LONG_VALUE
    digests = values.where(is_long).select(packed.alias("value")).groupBy("value").agg(n)

    def part(i: int, kind: str) -> Column:
        return F.get(F.split(v, r"\|"), i).cast(kind)

    measures = [part(1, "int").alias("len"), part(2, "int").alias("marks"), part(3, "double").alias("number")]
    return [
        _measured(field, values.where(~is_long).groupBy("value").agg(n), v),
        digests.select(F.lit(field).alias("field"), "n", F.lit(1).cast("long").alias("values"), *measures),
    ]


def _measured_integers(field: str, ints: DataFrame) -> DataFrame:
    """Words of the integers ``v`` with the measures of their texts, which are the same for all integers of a word.

    Integers that may differ from others of their word are rows of their own.
    """
    counted = ints.groupBy(words.word().alias("word"), words.apart().alias("apart")).agg(
        words.bits().alias("bits"), F.max("v").alias("last"), F.count(F.lit(1)).alias("n")
    )
    text = as_text(F.coalesce("apart", F.shiftleft("word", 6)))
    v = F.col("text")
    return counted.select("n", "bits", "last", text.alias("text")).select(
        F.lit(field).alias("field"),
        "n",
        F.coalesce(F.bit_count("bits"), F.lit(1)).cast("long").alias("values"),
        F.length(v).alias("len"),
        patterns.integer_marks(v).alias("marks"),
        F.col("last").cast("double").alias("number"),
    )


def _measured_histogram(tables: Tables) -> DataFrame:
    """One row per distinct value of a field id, or per word of integers: rows, values, length, marks and greatest number.

    The recognisers run once per distinct value, after counting. Every field is counted by a scan of its own column,
    in which the values are single keys: a row of all fields taken apart costs several times as much. Doubles, dates
    and timestamps are counted as they are and become text only then; integers are counted as words.
    """
    v, n = F.col("value"), F.count(F.lit(1)).alias("n")
    parts = []
    for field, df, name, kind in _fields(tables):
        if kind == "string":
            parts += _measured_texts(field, df.select(normalize(name).alias("value")))
            continue
        values = df.select(col(name).cast(kind).alias("value"))
        if kind == "double":
            counted = values.groupBy("value", is_minus_zero(v).alias("minus")).agg(n)
            text = F.when(F.col("minus"), F.lit("-0.0")).otherwise(as_text("value"))
            parts.append(_measured(field, counted, text, v))
        elif kind == "bigint":
            parts.append(_measured_integers(field, values.withColumnRenamed("value", "v")))
        else:
            nothing = F.lit(None).cast("double")
            parts.append(_measured(field, values.groupBy("value").agg(n), as_text("value"), nothing))
    return reduce(DataFrame.unionByName, parts)


def _summary(tables: Tables) -> DataFrame:
    """The measured histogram by length and marks: what counts and moments need, in a few rows per field."""
    number = F.when(F.abs("number") < float("inf"), F.col("number"))  # all values that parse, NaN and infinities aside
    return _measured_histogram(tables).groupBy("field", "len", "marks").agg(
        F.sum("n").alias("n"),
        F.sum("values").alias("values"),
        F.max(number).alias("max_number"),
        F.max(number % F.lit(1.0)).alias("max_fraction"),
    )


def _with_names(df: DataFrame, tables: Tables) -> DataFrame:
    """A frame with one row per field, its id replaced by the field's names and position."""
    entries = []
    for i, (sys_code, table_code, col_num, col_code) in enumerate(_field_numbers(tables)):
        named = F.struct(
            F.lit(sys_code).alias("sys_code"),
            F.lit(table_code).alias("table_code"),
            F.lit(col_code).alias("col_code"),
            F.lit(col_num).alias("col_num"),
        )
        entries += [F.lit(str(i)), named]
    return df.withColumn("_named", F.create_map(*entries)[F.col("field")]).select(
        "_named.*", *[c for c in df.columns if c != "field"]
    )


def _counts(summary: DataFrame) -> DataFrame:
    filled = F.col("len") > 0
    marks, n = F.col("marks"), F.col("n")
    vote = patterns.type_vote(marks)

    def rows(condition: Column) -> Column:
        return F.sum(F.when(filled & condition, n).otherwise(0))

    return summary.groupBy("field").agg(
        F.sum("n").alias("records"),
        F.sum("values").alias("distinct"),
        F.sum(F.when(filled, F.col("values")).otherwise(0)).alias("filled_distinct"),
        F.sum(F.when(filled, n).otherwise(0)).alias("filled"),
        F.coalesce(F.max(F.when(filled, F.col("len"))), F.lit(0)).alias("max_len"),
        F.coalesce(F.min(F.when(filled, F.col("len"))), F.lit(0)).alias("min_len"),
        F.max(patterns.has_mark(marks, patterns.CHINESE_BIT)).alias("has_chinese"),
        F.max("max_number").alias("max_number"),
        F.max("max_fraction").alias("max_fraction"),
        *[rows(vote == k).alias(f"vote_{k}") for k in patterns.VOTE_ORDER],
        *[
            rows(patterns.has_mark(marks, bit)).alias(f"is_{kind}")
            for kind, bit in [
                ("integer", patterns.INTEGER_BIT),
                ("float", patterns.FLOAT_BIT),
                ("date", patterns.DATE_BIT),
                ("time", patterns.TIME_BIT),
                ("timestamp", patterns.TIMESTAMP_BIT),
            ]
        ],
    )


def _length_moments(summary: DataFrame) -> DataFrame:
    """Moments of the value lengths from the histogram of lengths, which is small. Blanks get weight 0."""
    weight = F.when(F.col("len") > 0, F.col("n")).otherwise(0)
    sizes = summary.groupBy("field", "len").agg(F.sum(weight).alias("n"))
    per_field = Window.partitionBy("field")
    total = F.sum(F.col("len") * F.col("n")).over(per_field)
    mean = F.try_divide(total, F.sum("n").over(per_field))
    deviation = F.col("len") - F.col("avg_len")
    sums = (
        sizes.withColumn("avg_len", mean)
        .groupBy("field")
        .agg(
            F.first("avg_len").alias("avg_len"),
            F.expr("percentile(len, 0.5D, n)").alias("median_len"),
            F.sum("n").cast("double").alias("n"),
            *[F.sum(F.pow(deviation, F.lit(k)) * F.col("n")).alias(f"s{k}") for k in (2, 3, 4)],
        )
    )
    n, s2, s3, s4 = (F.col(c) for c in ("n", "s2", "s3", "s4"))
    return sums.select(
        "field",
        "avg_len",
        "median_len",
        moments.sample_variance(n, s2).alias("var_len"),
        moments.sample_skewness(n, s2, s3).alias("skew_len"),
        moments.sample_kurtosis(n, s2, s4).alias("kurt_len"),
    )


def _integer(value: Column) -> Column:
    """The integer in a text of digits; NULL for other texts."""
    return F.when(patterns.full_match(value, patterns.DIGITS), value.try_cast("bigint"))


def _words(ints: DataFrame, key: list[str]) -> DataFrame:
    """``(key, word, bits, rows)``: the integers ``v`` of each key as bits of 64-bit words, and rows per word.

    The map tasks reduce rows to words. NULLs meet in one group per key that counts for nothing.
    """
    return ints.groupBy(*key, words.word().alias("word")).agg(words.bits().alias("bits"), F.count("v").alias("rows"))


def _sequence_steps(counted: DataFrame, key: list[str]) -> DataFrame:
    """Per key: rows holding an integer, and distinct integers v whose v + 1 is there too.

    In sorted order these v are exactly the neighbours with difference 1, but no sort is needed: steps
    inside a word are counted with bit operations, and only word borders are matched up.
    """
    inside = F.bit_count(F.col("bits").bitwiseAND(F.shiftrightunsigned("bits", 1)))
    has_last, has_first = F.col("bits") < 0, F.col("bits").bitwiseAND(F.lit(1)) != 0
    borders = counted.select(
        *key,
        F.inline(
            F.array(
                F.struct(
                    F.col("word").alias("border"),
                    F.when(has_last, 1).otherwise(0).alias("sides"),
                    inside.cast("long").alias("inside"),
                    F.col("rows").alias("rows"),
                ),
                F.struct(
                    (F.col("word") - 1).alias("border"),
                    F.when(has_first, 2).otherwise(0).alias("sides"),
                    F.lit(0).cast("long").alias("inside"),
                    F.lit(0).cast("long").alias("rows"),
                ),
            )
        ),
    )
    matched = borders.groupBy(*key, "border").agg(
        F.bit_or("sides").alias("sides"), F.sum("inside").alias("inside"), F.sum("rows").alias("rows")
    )
    return matched.groupBy(*key).agg(
        (F.sum("inside") + F.count_if(F.col("sides") == 3)).alias("steps"),
        F.sum("rows").alias("int_rows"),
    )


def _field_steps(tables: Tables, chosen: set[str]) -> DataFrame:
    """``_sequence_steps`` of some field ids."""
    parts = []
    for field, df, name, kind in _fields(tables):
        if field in chosen:
            v = col(name).cast(kind) if kind == "bigint" else _integer(normalize(name))
            parts.append(_words(df.select(F.lit(field).alias("field"), v.alias("v")), ["field"]))
    if not parts:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "field string, steps long, int_rows long")
    return _sequence_steps(reduce(DataFrame.unionByName, parts), ["field"])


def _sequence_rate() -> Column:
    return F.when(F.col("int_rows") > 1, F.col("steps") / (F.col("int_rows") - 1)).otherwise(0.0)


def autoincrement(df: DataFrame, column: str, threshold: float = defaults.AUTOINCREMENT_THRESHOLD) -> DataFrame:
    """Rate of steps of 1 between neighbouring integers of a column, and the verdict."""
    ints = df.select(F.lit(column).alias("col_code"), _integer(col(column).cast("string")).alias("v"))
    rate = F.round(_sequence_rate(), 12)
    steps = _sequence_steps(_words(ints, ["col_code"]), ["col_code"])
    return steps.select(
        "col_code", "int_rows", "steps", rate.alias("rate"), (rate >= threshold).alias("autoincrement")
    )


def _elected() -> Column:
    """The class with most votes and its accepted rows; on equal counts the first in order."""
    ranked = [
        F.struct(
            F.col(f"vote_{kind}").alias("votes"),
            F.lit(-i).alias("order"),
            F.lit(kind).alias("kind"),
            F.col("filled" if kind == "character" else f"is_{kind}").alias("accepted"),
        )
        for i, kind in enumerate(patterns.VOTE_ORDER)
    ]
    return F.when(F.col("filled") > 0, F.greatest(*ranked))


def _typed(counts: DataFrame, threshold: float) -> DataFrame:
    """Adds vote, rate of the voted class over all values, data type and physical type."""
    counts = counts.withColumn("elected", _elected()).select(
        "*",
        F.col("elected.kind").alias("vote"),
        F.coalesce(F.try_divide("elected.accepted", "filled"), F.lit(0.0)).alias("data_type_rate"),
    )
    fixed = F.col("max_len") == F.col("min_len")
    text_type = F.when(fixed, "CHAR").otherwise("VARCHAR")
    too_long = F.col("max_len") > defaults.MAX_INTEGER_LEN
    accepted = F.col("data_type_rate") >= threshold
    data_type = (
        F.when(F.col("filled") == 0, "UNK")
        .when(F.col("vote") == "character", text_type)
        .when(~accepted, text_type)
        .when((F.col("vote") == "integer") & too_long, text_type)
        .when(F.col("vote") == "integer", "INTEGER")
        .when(F.col("vote") == "float", "DECIMAL")
        .otherwise(F.upper("vote"))
    )
    col_type = (
        F.when(F.col("data_type") == "CHAR", "CHARACTER")
        .when(F.col("data_type") == "DECIMAL", "DOUBLE")
        .when(F.col("data_type").isin("DATE", "TIME", "TIMESTAMP"), F.col("data_type"))
        .when((F.col("data_type") == "INTEGER") & (F.col("max_len") <= 4), "SMALLINT")
        .when((F.col("data_type") == "INTEGER") & (F.col("max_len") >= 9), "BIGINT")
        .when(F.col("data_type") == "INTEGER", "INTEGER")
        .otherwise("VARCHAR")
    )
    return (
        counts.withColumn("fixed_length", (F.col("filled") > 0) & fixed)
        .withColumn("data_type", data_type)
        .withColumn("col_type", col_type)
        .withColumn(
            "sequence_eligible",
            (F.col("vote") == "integer")
            & ~(accepted & too_long)
            & (F.col("data_type_rate") >= defaults.AUTOINCREMENT_MIN_RATE),
        )
    )


def _category() -> Column:
    """Business category of a field, from its counts and type."""
    n, d = F.col("filled"), F.col("filled_distinct")
    few_values = (
        ((n > 1000) & (d < 20))
        | ((n > 100) & (n <= 1000) & (d < 10))
        | ((n > 20) & (n <= 100) & (d < 5))
    )
    is_code = (
        ~F.col("has_chinese")
        & (F.col("max_len") <= 10)
        & (n != d)
        & ~F.col("col_code").rlike(patterns.CODE_NAME_EXCLUSIONS)
        & few_values
    )
    kind = F.col("data_type")
    return (
        F.when(kind.isin("DATE", "TIME", "TIMESTAMP"), "DATE")
        .when((kind == "INTEGER") & is_code, "CODE")
        .when(kind == "INTEGER", "NUM")
        .when((kind == "DECIMAL") & (F.col("max_number") < 1), "RATE")
        .when((kind == "DECIMAL") & (F.col("max_fraction") == 0), "NUM")
        .when((kind == "DECIMAL") & F.col("max_number").isNotNull(), "AMOUNT")
        .when(kind.isin("CHAR", "VARCHAR") & is_code, "CODE")
        .otherwise("UNK")
    )


def profile_tables(
    tables: Tables,
    min_records: int = defaults.MIN_RECORDS,
    type_threshold: float = defaults.COL_TYPE_THRESHOLD,
    sequence_threshold: float = defaults.AUTOINCREMENT_THRESHOLD,
) -> DataFrame:
    """The profile of every usable column of every table with enough rows.

    Distinct values are shuffled once and reduced to a summary of a few rows per field. The driver learns which fields
    may be sequences, and only these are read again.
    """
    summary = settled(_summary(tables))
    typed = _typed(_counts(summary), type_threshold)
    steps = _field_steps(tables, {r["field"] for r in typed.where("sequence_eligible").select("field").collect()})
    joined = typed.join(_length_moments(summary), "field", "left").join(steps, "field", "left")
    joined = _with_names(joined, tables)
    sequence = F.col("sequence_eligible") & (_sequence_rate() >= sequence_threshold)

    def or_zero(name: str) -> Column:
        return F.when(F.col("filled") == 0, 0.0).otherwise(F.col(name)).alias(name)

    return joined.where(F.col("records") >= min_records).select(
        "sys_code",
        "table_code",
        "col_num",
        "col_code",
        "records",
        "distinct",
        "max_len",
        "min_len",
        *[or_zero(c) for c in ("avg_len", "median_len", "var_len", "skew_len", "kurt_len")],
        "has_chinese",
        (F.col("filled") < F.col("records")).alias("nullable"),
        (F.col("filled_distinct") == 1).alias("default_value"),
        "fixed_length",
        F.coalesce(sequence, F.lit(False)).alias("autoincrement"),
        "data_type",
        "data_type_rate",
        "col_type",
        _category().alias("tech_cate"),
        F.lit(False).alias("col_pk"),
    )


def profile_table(df: DataFrame, sys_code: str, table_code: str, **options) -> DataFrame:
    return profile_tables({(sys_code, table_code): df}, **options)


def table_info(tables: Tables, min_records: int = defaults.MIN_RECORDS) -> DataFrame:
    """``(sys_code, table_code, col_num)``: the number of usable columns of each table."""
    profile = profile_tables(tables, min_records)
    return profile.groupBy("sys_code", "table_code").agg(F.max("col_num").alias("col_num"))


def type_votes(tables: Tables) -> DataFrame:
    """Rows of every column that each recogniser accepts, and the votes per class."""
    counts = _with_names(_counts(_summary(tables)), tables)
    kinds = ("integer", "float", "date", "time", "timestamp")
    return counts.select(
        *FIELD,
        "filled",
        *[f"is_{k}" for k in kinds],
        *[f"vote_{k}" for k in patterns.VOTE_ORDER],
        _elected().getField("kind").alias("vote"),
    )


def length_moments(tables: Tables) -> DataFrame:
    return _with_names(_length_moments(_summary(tables)), tables).drop("col_num")


def has_chinese(tables: Tables) -> DataFrame:
    found = patterns.has_chinese(F.col("value"))
    return long_values(tables).groupBy(*FIELD).agg(F.max(found).alias("has_chinese"))


def code_values(tables: Tables, profile: DataFrame | None = None) -> DataFrame:
    """``(sys_code, table_code, col_code, code_value)`` of all fields categorised as codes.

    The driver learns the names of these fields, and only they are read. A code has fewer than 20 values, which the map
    tasks reduce first, so next to nothing is shuffled. Code values have at most 10 characters.
    """
    profile = settled(profile_tables(tables) if profile is None else profile)
    codes: dict[tuple[str, str], list[str]] = {}
    for r in profile.where(F.col("tech_cate") == "CODE").select(*FIELD).distinct().collect():
        if (key := (r["sys_code"], r["table_code"])) in tables and r["col_code"] in usable_columns(tables[key]):
            codes.setdefault(key, []).append(r["col_code"])
    if not codes:
        return long_values(tables).limit(0).withColumnRenamed("value", "code_value")
    values = long_values(tables, codes).where(F.length("value").between(1, 10)).distinct()
    return values.withColumnRenamed("value", "code_value")


def effective_type(profile: DataFrame) -> DataFrame:
    """The profile with ``effective_type``: the inferred type only if every value matches it."""
    fixed = F.col("max_len") == F.col("min_len")
    text_type = F.when(fixed, "CHARACTER").otherwise("VARCHAR")
    return profile.withColumn(
        "effective_type", F.when(F.col("data_type_rate") == 1.0, F.col("col_type")).otherwise(text_type)
    )


def encoded_flags(profile: DataFrame) -> DataFrame:
    """The profile with its flags as '0' and '1' and the reported length ``col_length``."""
    flags = ("nullable", "has_chinese", "default_value", "autoincrement", "col_pk")
    digits = {c: F.when(F.col(c), "1").otherwise("0") for c in flags}
    return profile.withColumns(digits).withColumn("col_length", F.col("max_len"))


def informative_columns(profile: DataFrame) -> DataFrame:
    """Fields that can tell rows apart: more than one value, and not a one-character flag."""
    return profile.where((F.col("distinct") > 1) & (F.col("max_len") != 1))


def profile_slices(profile: DataFrame) -> DataFrame:
    """Per table: rows, number of columns, and its one-character columns."""
    flags = F.array_sort(F.collect_set(F.when(F.col("max_len") == 1, F.col("col_code"))))
    return (
        profile.groupBy("sys_code", "table_code")
        .agg(
            F.max("records").alias("records"),
            F.count(F.lit(1)).alias("columns"),
            F.array_join(flags, ",").alias("flag_columns"),
        )
        .orderBy("records", "columns", "sys_code", "table_code")
    )


__all__ = [
    "PROFILE_COLUMNS", "autoincrement", "code_values", "effective_type", "encoded_flags", "has_chinese",
    "informative_columns", "length_moments", "profile_slices", "profile_table", "profile_tables",
    "table_info", "type_votes",
]
