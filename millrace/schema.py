"""The canonical listing record: one row of a rental listing, everything nullable but its source."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names by type, in record order within each group.
STRINGS = (
    "source source_listing_id source_url scraped_at publication_date last_updated_date active_status active_evidence title description raw_description"
    " district subarea address coord_source coord_precision rent_currency rent_pen_basis rent_usd_basis maintenance_currency maintenance_pen_basis"
    " maintenance_usd_basis property_type operation utilities_included agent_name agency_name phone whatsapp main_image_url"
).split()
DOUBLES = (
    "latitude longitude rent_original rent_pen rent_usd maintenance_fee maintenance_pen maintenance_usd estimated_total_monthly_pen"
    " estimated_total_monthly_usd fx_rate_usd_pen bathrooms total_area_m2 built_area_m2 deposit_months advance_months"
).split()
INTEGERS = "bedrooms floor total_floors parking_spaces minimum_contract_months image_count".split()
BOOLEANS = (
    "maintenance_included_in_rent parking_included furnished semi_furnished balcony terrace laundry interior_view exterior_view acoustic_windows study"
    " walk_in_closet avenue_view quiet_claim studio_text short_term_text shared_room_text internet_included elevator security_24h gym pool coworking"
    " common_areas pets_allowed"
).split()
ARRAYS = "image_keys amenities text_signals".split()

KINDS = {c: kind for columns, kind in ((STRINGS, T.StringType()), (DOUBLES, T.DoubleType()), (INTEGERS, T.IntegerType()), (BOOLEANS, T.BooleanType()), (ARRAYS, T.ArrayType(T.StringType()))) for c in columns}

LISTING = T.StructType([T.StructField(c, kind, c != "source") for c, kind in KINDS.items()])


def conform(df):
    """All listing columns, missing ones as typed nulls (empty arrays for lists), NaN as null; other columns stay."""
    from pyspark.sql import functions as F

    def column(c: str, kind: T.DataType):
        if c not in df.columns:
            return (F.array().cast(kind) if c in ARRAYS else F.lit(None).cast(kind)).alias(c)
        value = F.col(c).cast(kind)
        if isinstance(kind, T.DoubleType):
            value = F.nullif(value, F.lit(float("nan")))
        return (F.coalesce(value, F.array().cast(kind)) if c in ARRAYS else value).alias(c)

    return df.select(*[F.col(c) for c in df.columns if c not in KINDS], *[column(c, kind) for c, kind in KINDS.items()])
