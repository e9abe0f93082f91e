"""The dashboard pages as bundles of DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.operators import geo
from devigil.operators.filters import build_filter, restrict_to, search
from devigil.operators.forecast import forecast
from devigil.operators.harmonize import integrate, join_events
from devigil.operators.features import FeatureSpec
from devigil.operators.marts import address_mart, device_mart, manufacturer_mart
from devigil.operators.models import (
    Scorer,
    prediction_summary,
    score_devices,
    score_event_types,
)
from devigil.operators.reports import (
    count_by,
    key_figures,
    latest,
    monthly_trend,
    newest_first,
    top_categories,
    top_entities,
)
from devigil.operators.series import monthly_counts, policy_overlay
from devigil.operators.text_components import fit_components

# --- fixed values: columns of the event page -----------------------------------------------------
EVENT_PAGE_COLUMNS = (
    "openfda_device_name", "event_id", "adverse_event_flag", "date_facility_aware",
    "date_of_event", "date_report_to_fda", "date_report_to_manufacturer", "event_type",
    "health_professional", "product_problems", "number_devices_in_event",
    "number_patients_in_event", "manufacturer_d_name", "manufacturer_d_country",
    "manufacturer_d_postal_code", "manufacturer_d_state",
)
# --- end of fixed values ------------------------------------------------------------------------
EVENT_TEXT_FILTERS = {
    "device_name": "openfda_device_name",
    "manufacturer_d_name": "manufacturer_d_name",
    "event_type": "event_type",
}
RECALL_TEXT_FILTERS = {"device_name": "openfda_device_name", "recalling_firm": "recalling_firm"}


def home(
    tables: Mapping[str, DataFrame],
    query: str | None = None,
    manufacturer_metric: str = "deaths",
    device_metric: str = "deaths",
    n: int = 5,
) -> dict[str, DataFrame]:
    """Manufacturer, device and address tables, cross-filtered by a manufacturer search.

    ``tables`` has the sources ``device_events``, ``recall``, ``pma_submission`` and ``submission``.
    """
    integrated = integrate(tables)
    manufacturers = search(manufacturer_mart(integrated), "manufacturer_name", query)
    devices = restrict_to(device_mart(integrated), manufacturers, "manufacturer_name")
    addresses = restrict_to(address_mart(integrated), manufacturers, "manufacturer_name")
    return {
        "manufacturers": manufacturers,
        "devices": devices,
        "addresses": addresses,
        "top_manufacturers": top_entities(
            manufacturers, "manufacturer_name", manufacturer_metric, n
        ),
        "top_devices": top_entities(devices, "device_name", device_metric, n),
    }


def filtered_events(
    events: DataFrame, devices: DataFrame, filters: Mapping[str, object] | None = None
) -> DataFrame:
    rows = join_events(events, devices).select(*EVENT_PAGE_COLUMNS)
    return rows.filter(build_filter(filters, EVENT_TEXT_FILTERS, "date_of_event"))


def filtered_recalls(
    recalls: DataFrame, filters: Mapping[str, object] | None = None
) -> DataFrame:
    equal = {"root_cause_description": "root_cause_description"}
    return recalls.filter(build_filter(filters, RECALL_TEXT_FILTERS, "event_date_posted", equal))


def _page(
    rows: DataFrame,
    date_column: str,
    category: str,
    firm: str,
    key: str,
    reference: date,
    place: tuple[str, str],
    gazetteer: DataFrame | None,
    zoom: int,
) -> dict[str, DataFrame]:
    series = monthly_counts(rows, date_column)
    predicted = forecast(series)
    page = {
        "records": newest_first(rows, date_column, nulls_first=True),
        "figures": key_figures(rows, date_column, F.lit(reference)),
        "by_category": count_by(rows, category),
        "top_firms": top_categories(rows, firm),
        "forecast": predicted,
        "policies": policy_overlay(predicted),
        "latest": latest(rows, date_column, tie_break=[key], drop=[key]),
    }
    if gazetteer is not None:
        points = geo.counted_points(rows, *place, gazetteer)
        page["density"] = geo.hexbin(points, zoom)
        page["centroid"] = geo.centroid(points)
    return page


def events_page(
    events: DataFrame,
    devices: DataFrame,
    filters: Mapping[str, object] | None,
    reference: date,
    gazetteer: DataFrame | None = None,
    zoom: int = 9,
) -> dict[str, DataFrame]:
    rows = filtered_events(events, devices, filters)
    place = ("manufacturer_d_country", "manufacturer_d_postal_code")
    return _page(
        rows, "date_of_event", "event_type", "manufacturer_d_name", "event_id", reference, place,
        gazetteer, zoom,
    )


def recalls_page(
    recalls: DataFrame,
    filters: Mapping[str, object] | None,
    reference: date,
    gazetteer: DataFrame | None = None,
    zoom: int = 9,
) -> dict[str, DataFrame]:
    rows = filtered_recalls(recalls, filters)
    page = _page(
        rows, "event_date_posted", "openfda_device_class", "recalling_firm", "id", reference,
        ("country", "postal_code"), gazetteer, zoom,
    )
    page["root_causes"] = count_by(rows, "root_cause_description", ordered=True)
    page["trend"] = monthly_trend(rows, "event_date_posted", F.lit(reference))
    return page


def cluster_members(clusters: DataFrame, name: str, chosen: str) -> DataFrame:
    """The rows of ``clusters`` in a cluster with a row called ``chosen``, whatever its case."""
    wanted = clusters.filter(F.lower(name) == chosen.lower()).select("cluster").distinct()
    return clusters.join(wanted, "cluster", "left_semi")


def cluster_view(clusters: DataFrame, name: str) -> DataFrame:
    """``name, cluster, x, y``: the distinct named members of clusters on two text components."""
    rows = clusters.select(name, "cluster").filter(F.col(name).isNotNull()).distinct()
    scores = fit_components(rows, name, 2).scores(rows, name).withColumnRenamed("text", name)
    at = F.coalesce("score", F.array().cast("array<double>"))
    return rows.join(scores, name, "left").select(
        name, "cluster", F.coalesce(F.get(at, 0), F.lit(0.0)).alias("x"),
        F.coalesce(F.get(at, 1), F.lit(0.0)).alias("y"),
    )


def predictions_page(
    features: DataFrame,
    device: str,
    recall: tuple[Scorer, FeatureSpec],
    event_types: tuple[Scorer, FeatureSpec, tuple[str, ...]],
    clusters: DataFrame,
    name: str,
) -> dict[str, DataFrame]:
    """One device: its recall probability, its likeliest event types, its facts, and the names that
    cluster with it; and all clusters in two dimensions."""
    own = features.filter(F.lower("device_name") == device.lower())
    types_model, types_spec, targets = event_types
    return {
        "recall": score_devices(recall[0], own, recall[1]),
        "event_types": score_event_types(types_model, own, targets, types_spec),
        "summary": prediction_summary(own),
        "members": cluster_members(clusters, name, device),
        "view": cluster_view(clusters, name),
    }
