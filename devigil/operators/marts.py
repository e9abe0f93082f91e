"""Device, manufacturer and address marts over the integrated table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEVICE_KEYS = (
    "device_name",
    "manufacturer_name",
    "device_class",
    "regulation_number",
    "medical_specialty_description",
)
OUTCOMES = {
    "deaths": "death",
    "injuries": "injury",
    "malfunctions": "malfunction",
    "other": "other",
    "recalls": "recall",
}
CLASSES = {"class_1": "1", "class_2": "2", "class_3": "3"}
ADDRESS = (
    "manufacturer_name",
    "manufacturer_street",
    "manufacturer_city",
    "manufacturer_state",
    "manufacturer_country",
    "manufacturer_postal_code",
)
DEVICE_ORDER = ("manufacturer_name", "device_class", "device_name")


MEASURES = {**OUTCOMES, **CLASSES}
NUMBERS = {"pma_submissions": "pma_number", "k_submissions": "k_number"}


def _pieces(integrated: DataFrame, distinct: dict[str, str]) -> DataFrame:
    """Every row once for its sums and once more per present value that is counted distinctly.

    Spark's own plan for several distinct counts repeats every row for each of them. Here most
    rows, the events, have no submission numbers and stay single. ``piece`` is ``sums`` or the
    name of a distinct count, ``value`` the counted value.
    """
    wanted = dict.fromkeys([*DEVICE_KEYS, *distinct.values(), *MEASURES.values()])
    rows = integrated.select(*[f"`{c}`" for c in wanted])
    values = [
        F.when(
            F.col(column).isNotNull(),
            F.struct(F.lit(name).alias("piece"), F.col(column).alias("value")),
        )
        for name, column in distinct.items()
    ]
    sums = F.struct(F.lit("sums").alias("piece"), F.lit(None).cast("string").alias("value"))
    return rows.withColumn("p", F.explode(F.array_compact(F.array(sums, *values)))).select(
        "*", "p.piece", "p.value"
    )


def _reduced(pieces: DataFrame, keys: list, parts: int | None, near: list) -> DataFrame:
    """Measures per key, piece and value: a distinct value is one row afterwards.

    With ``parts``, rows are dealt into so many by the columns ``near`` first. Devices are about as
    many as facts, so what a task has summed up before would be as large as its share of the input.
    """
    is_sum = F.col("piece") == "sums"
    if parts:
        pieces = pieces.repartition(parts, *near)
    return pieces.groupBy(*keys, "piece", "value").agg(
        *[
            F.sum(F.when(is_sum, F.col(f"`{c}`")).otherwise(0)).alias(name)
            for name, c in MEASURES.items()
        ],
        F.count(F.when(is_sum, F.col("device_name"))).alias("records"),
    )


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in OUTCOMES]


def _flags() -> list[Column]:
    """1 if any row of the group has the class, which is also the sum of its distinct 0/1 values."""
    return [F.max((F.col(name) > 0).cast("bigint")).alias(name) for name in CLASSES]


def _counted(*names: str) -> list[Column]:
    return [F.count_if(F.col("piece") == name).alias(name) for name in names]


def _ordered(df: DataFrame, *columns: str) -> DataFrame:
    """NULLs last; the remaining columns break ties and spread a hot leading value."""
    rest = [c for c in df.columns if c not in columns]
    return df.orderBy(*[F.asc_nulls_last(c) for c in (*columns, *rest)])


def device_view(integrated: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per device key, NULL keys included, summed up in ``parts`` if given."""
    keys = [F.col(k) for k in DEVICE_KEYS]
    reduced = _reduced(_pieces(integrated, NUMBERS), keys, parts, keys)
    return reduced.groupBy(*DEVICE_KEYS).agg(
        *_sums(), *_flags(), F.sum("records").alias("records"), *_counted(*NUMBERS)
    )


def mart_columns() -> list[str]:
    """The columns of integrated rows that views and marts read, addresses apart."""
    return list(dict.fromkeys([*DEVICE_KEYS, *NUMBERS.values(), *MEASURES.values()]))


def device_mart(integrated: DataFrame, parts: int | None = None) -> DataFrame:
    return _ordered(device_view(integrated, parts), *DEVICE_ORDER)


def manufacturer_mart(
    integrated: DataFrame, compat: bool = False, parts: int | None = None
) -> DataFrame:
    """One row per manufacturer, counting its devices per class.

    Submissions are the distinct numbers of the manufacturer. ``compat`` counts the distinct
    *per-device counts* instead, for comparison with figures that were made that way.
    """
    devices_per_class = "num_{}_devices"
    if compat:
        mart = (
            device_view(integrated, parts)
            .groupBy("manufacturer_name")
            .agg(
                *_sums(),
                *[F.sum(name).alias(devices_per_class.format(name)) for name in CLASSES],
                F.count_distinct("device_name").alias("unique_devices"),
                F.count_distinct("pma_submissions").alias("pma_submissions"),
                F.count_distinct("k_submissions").alias("k_submissions"),
            )
        )
    else:
        mart = (
            _per_manufacturer(integrated, parts)
            .groupBy("manufacturer_name")
            .agg(
                *_sums(),
                *[
                    F.count_if(F.col(name) > 0).alias(devices_per_class.format(name))
                    for name in CLASSES
                ],
                *_counted("unique_devices", *NUMBERS),
            )
        )
    return _ordered(mart, "manufacturer_name")


def _per_manufacturer(integrated: DataFrame, parts: int | None = None) -> DataFrame:
    """Sums per device key, and one row per distinct device name and submission number."""
    pieces = _pieces(integrated, {"unique_devices": "device_name", **NUMBERS})
    of_device = [
        F.when(F.col("piece") == "sums", F.col(key)).alias(f"device_{i}")
        for i, key in enumerate(DEVICE_KEYS)
        if key != "manufacturer_name"
    ]
    near = [F.col("manufacturer_name"), *of_device, F.col("piece"), F.col("value")]
    return _reduced(pieces, near[:-2], parts, near)


def manufacturer_view(integrated: DataFrame, parts: int | None = None) -> DataFrame:
    """The SQL-view form: class flags of the manufacturer instead of device counts.

    No sum of a device is asked for, so the sums of a manufacturer are one row of each task before they
    are shuffled, with or without ``parts``.
    """
    pieces = _pieces(integrated, {"unique_devices": "device_name", **NUMBERS})
    return (
        _reduced(pieces, [F.col("manufacturer_name")], None, [])
        .groupBy("manufacturer_name")
        .agg(*_sums(), *_flags(), *_counted("unique_devices", *NUMBERS))
    )


def address_view(integrated: DataFrame) -> DataFrame:
    return integrated.select(*ADDRESS).distinct()


def address_mart(integrated: DataFrame) -> DataFrame:
    return _ordered(address_view(integrated), "manufacturer_name")


def create_views(integrated: DataFrame, parts: int | None = None) -> None:
    device_view(integrated, parts).createOrReplaceTempView("integrated_device_view")
    manufacturer_view(integrated, parts).createOrReplaceTempView("integrated_manufacturer_view")
    address_view(integrated).createOrReplaceTempView("integrated_manufacturer_address_view")
