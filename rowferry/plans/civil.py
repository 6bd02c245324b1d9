"""The civil-registration load plan: nine tables from reference data to birth certificates.

Source relations are passed in by name, so they can be Parquet, JDBC or views.
A target's id is the source id, carried as text in ``uuid``: lookups read it
back as a number, which keeps ids the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions import Columns, full_name
from rowferry.operators.joins import Dimension, join_dimensions
from rowferry.operators.lookup import ForeignKey, LookupSpec, build_lookups, resolve_codes
from rowferry.operators.project import Transform, audit_fields, custom_transformer, load_time, map_fields
from rowferry.plans.spec import TableLoad

# Columns of the birth certificate target that a plain rename fills;
# the source column is the same name in upper case.
CERTIFICATE_FIELDS = (
    "provided_pin_no", "old_pin_no", "notification_no", "first_name", "middle_name", "last_name",
    "other_name", "jamii_no", "birth_date", "sex_code",
    "place_of_birth_id", "place_of_birth_name", "country_birth_id", "country_birth_name",
    "facility_id", "facility_name",
    "region_birth_id", "region_birth_name", "district_birth_id", "district_birth_name",
    "ward_birth_id", "ward_birth_name",
    "registration_date", "registrar_name",
    "mother_first_name", "mother_middle_name", "mother_sur_name", "mother_other_name",
    "mother_birth_country_id", "mother_birth_country_name", "mother_jamii_no",
    "father_first_name", "father_middle_name", "father_sur_name", "father_other_name",
    "father_birth_country_id", "father_birth_country_name", "father_jamii_no",
    "created_date", "photo_ref_no", "is_migrated_data", "migrated_date", "last_updated_by_id",
    "last_updated_date", "last_updated_by_email", "certificate_status_id", "last_track_date",
    "child_full_name", "mother_full_name", "father_full_name",
    "first_printed_date", "printed_count", "last_printed_date", "attachment",
)

CERTIFICATE_FIELD_MAP = {name.upper(): name for name in CERTIFICATE_FIELDS}

# Where the ids of each location table are found by code.
LOCATION_LOOKUPS = (
    LookupSpec("region", "code", "id"),
    LookupSpec("district", "code", "id", ("region",)),
    LookupSpec("council", "code", "id", ("district",)),
    LookupSpec("ward", "code", "ward_id", ("council",)),
    LookupSpec("health_facility", "code", "health_facility_id", ("council",)),
)

# The lookups a birth certificate uses.
BIRTH_LOOKUPS = (
    LookupSpec("region", "code", "id"),
    LookupSpec("district", "code", "id", ("region",)),
    LookupSpec("ward", "code", "ward_id", ("council",)),
    LookupSpec("country", "country_code", "id"),
    LookupSpec("health_facility", "code", "health_facility_id", ("council",)),
    LookupSpec("place_of_birth", "code", "id"),
)

# Columns read from each source relation.
LOOKUP_COLUMNS = {
    "country": ("ID", "NAME", "CODE", "INTL_CODE"),
    "region": ("ID", "CODE", "NAME", "POST_CODE", "ACTIVE", "INTL_CODES"),
    "registration_center_type": ("ID", "CODE", "DESCRIPTION"),
    "occupation": ("ID", "NAME", "DESC_SWAHILI", "CODE"),
    "place_of_birth": ("ID", "CODE", "DESCRIPTION", "DESC_SWAHILI", "JN_CODE"),
    "place_of_death": ("ID", "CODE", "DESCRIPTION", "DESC_SWAHILI"),
    "present_on_delivery": ("ID", "NAME", "DESC_SWAHILI", "CODE"),
    "hospitals": ("ID", "NAME", "COUNCIL", "JN_CODE"),
    "relations": ("ID", "CODE", "DESCRIPTION", "DESC_SWAHILI"),
    "sex": ("ID", "CODE", "DESCRIPTION", "DESC_SWAHILI"),
    "type_of_birth": ("ID", "CODE", "DESCRIPTION", "DESC_SWAHILI", "JN_CODE"),
    "type_of_death": ("ID", "CODE", "DESCRIPTION"),
    "type_of_disability": ("ID", "NAME", "DESCRIPTION", "DESC_SWAHILI", "CODE"),
}

# Fixed value: the first creation day of a birth registration that is moved.
BIRTHS_FROM = "01-JANUARY-2024"

Relations = Mapping[str, DataFrame]


def lookup_source(tables: Relations, name: str) -> DataFrame:
    return tables[name].select(*LOOKUP_COLUMNS[name])


def district_source(tables: Relations) -> DataFrame:
    district = tables["district"].select("ID", "CODE", "NAME", "REGION_ID", "POST_CODE", "ACTIVE")
    return join_dimensions(district, [Dimension(tables["region"], {"REGION_ID": "ID"}, {"CODE": "REGION_CODE"})])


def council_source(tables: Relations) -> DataFrame:
    council = tables["council"].select("ID", "DISTRICT_ID", "CODE", "NAME", "POST_CODE", "ACTIVE", "MVC_UUID")
    return join_dimensions(
        council, [Dimension(tables["district"], {"DISTRICT_ID": "ID"}, {"CODE": "DISTRICT_CODE"})]
    )


def ward_source(tables: Relations) -> DataFrame:
    ward = tables["ward"].select("ID", "CODE", "NAME", "COUNCIL_ID", "POST_CODE", "ACTIVE")
    councils = Dimension(tables["council"], {"COUNCIL_ID": "ID"}, {"CODE": "COUNCIL_CODE", "DISTRICT_ID": "DISTRICT_ID"})
    districts = Dimension(tables["district"], {"DISTRICT_ID": "ID"}, {"CODE": "DISTRICT_CODE"})
    return join_dimensions(ward, [councils, districts]).drop("DISTRICT_ID")


def health_facility_source(tables: Relations) -> DataFrame:
    facility = tables["health_facility"].select("ID", "CODE", "NAME", "COUNCIL_ID", "POST_CODE", "ACTIVE")
    return join_dimensions(
        facility,
        [Dimension(tables["council"], {"COUNCIL_ID": "ID"}, {"CODE": "COUNCIL_CODE", "NAME": "COUNCIL_NAME"})],
    )


def registration_center_source(tables: Relations) -> DataFrame:
    places = [
        Dimension(tables[name], {f"{prefix}_ID": "ID"}, {"CODE": f"{prefix}_CODE", "NAME": f"{prefix}_NAME"})
        for name, prefix in (
            ("region", "REGION"),
            ("district", "DISTRICT"),
            ("council", "COUNCIL"),
            ("ward", "WARD"),
            ("health_facility", "HEALTH_FACILITY"),
        )
    ]
    kinds = Dimension(
        tables["registration_center_type"],
        {"REGISTRATION_CENTER_TYPE_ID": "ID"},
        {"CODE": "REG_CENTER_TYPE_CODE", "DESCRIPTION": "REG_CENTER_TYPE_DESC"},
    )
    return join_dimensions(tables["registration_center"], [*places, kinds])


def birth_source(tables: Relations, since: str = BIRTHS_FROM) -> DataFrame:
    """Births created since a day, with their person and, where known, the sex."""
    created = F.col("CREATED_DATE") >= F.to_timestamp_ntz(F.lit(since), F.lit("dd-MMMM-yyyy"))
    births = map_fields(
        tables["birth_registration"].where(created),
        {
            "CHILD_ID": "CHILD_ID", "ID": "BIRTH_REG_ID", "NOTIFICATION_NUMBER": "NOTIFICATION_NUMBER",
            "OLD_REGISTRATION_NUMBER": "OLD_PIN_NO", "REGISTRATION_DATE": "REGISTRATION_DATE",
            "CREATED_DATE": "CREATED_DATE", "MODIFIED_BY": "LAST_UPDATED_BY_ID",
            "MODIFIED_DATE": "LAST_UPDATED_DATE", "PLACE_OF_BIRTH_ID": "PLACE_OF_BIRTH_ID",
            "HOSPITAL_ID": "FACILITY_ID", "HOSPITAL_NAME": "FACILITY_NAME", "MOTHER_ID": "MOTHER_ID",
            "FATHER_ID": "FATHER_ID", "CERTIFICATE_PRINT_DATE": "FIRST_PRINTED_DATE",
            "CERTIFICATE_PRINT_BY": "CERTIFICATE_PRINT_BY", "TYPE_OF_BIRTH_ID": "TYPE_OF_BIRTH_ID",
            "WEIGHT_AT_BIRTH": "WEIGHT_AT_BIRTH", "STATUS_OF_BIRTH": "STATUS_OF_BIRTH",
        },
    )
    people = map_fields(
        tables["person"],
        {
            "ID": "CHILD_ID", "PIN": "PROVIDED_PIN_NO", "FIRST_NAME": "FIRST_NAME",
            "MIDDLE_NAME": "MIDDLE_NAME", "LAST_NAME": "LAST_NAME", "OTHER_NAMES": "OTHER_NAME",
            "NIN": "JAMII_NO", "DATE_OF_BIRTH": "BIRTH_DATE", "SEX_ID": "SEX_ID",
            "REGION_OF_BIRTH_ID": "REGION_BIRTH_ID", "DISTRICT_OF_BIRTH_ID": "DISTRICT_BIRTH_ID",
            "WARD_OF_BIRTH_ID": "WARD_BIRTH_ID", "COUNTRY_OF_BIRTH_ID": "COUNTRY_BIRTH_ID",
        },
    )
    pin = F.substring(F.col("PROVIDED_PIN_NO").cast("string"), 1, 50)
    joined = births.join(people.withColumn("PROVIDED_PIN_NO", pin), "CHILD_ID").drop("CHILD_ID")
    sexes = Dimension(tables.get("sex"), {"SEX_ID": "ID"}, {"CODE": "SEX_CODE", "DESCRIPTION": "SEX_DESCRIPTION"})
    return join_dimensions(joined, [sexes]).drop("SEX_ID")


@dataclass(frozen=True)
class Cleaning:
    """How a target table is made from its source, where that is not the rule.

    The rule: a target column comes from the source column of the same name in
    upper case, by the converter of its declared type.
    """

    sources: Mapping[str, str] = field(default_factory=dict)
    lengths: Mapping[str, int] = field(default_factory=dict)
    defaults: Mapping[str, str | int] = field(default_factory=dict)
    empty: tuple[str, ...] = ()
    made: Callable[[Columns, Column], Mapping[str, Column]] = lambda c, now: {}
    optional_sources: bool = False


def clean_table(schema: T.StructType, cleaning: Cleaning, load_ts: str) -> Transform:
    """The transform of a declared target; a source column that is not there is an error unless optional."""

    def value(c: Columns, target: T.StructField) -> Column:
        source = cleaning.sources.get(target.name, target.name.upper())
        default = cleaning.defaults.get(target.name)
        if target.name in cleaning.empty or (cleaning.optional_sources and not c.has(source)):
            return F.lit(default).cast(target.dataType)
        if isinstance(target.dataType, T.StringType):
            length = cleaning.lengths.get(target.name)
            return c.string(source, length) if default is None else c.string_or(source, default, length)
        if isinstance(target.dataType, T.LongType):
            return c.integer(source, default)
        return c.boolean(source) if isinstance(target.dataType, T.BooleanType) else c.date(source)

    def build(c: Columns) -> dict[str, Column]:
        made = {**audit_fields(load_ts), **cleaning.made(c, load_time(load_ts))}
        return {f.name: made[f.name] if f.name in made else value(c, f) for f in schema.fields}

    return custom_transformer(build)


def _full_names(c: Columns) -> dict[str, Column]:
    names = {}
    for who, prefix, last in (
        ("child", "", "LAST_NAME"),
        ("mother", "MOTHER_", "MOTHER_SUR_NAME"),
        ("father", "FATHER_", "FATHER_SUR_NAME"),
    ):
        parts = [c.text(p) for p in (f"{prefix}FIRST_NAME", f"{prefix}MIDDLE_NAME", last) if c.has(p)]
        names[f"{who}_full_name"] = full_name(*parts) if parts else F.lit("")
    return names


def _certificate_made(c: Columns, now: Column) -> dict[str, Column]:
    tracked = c.date("LAST_TRACK_DATE", default=now) if c.has("LAST_TRACK_DATE") else now
    return {**_full_names(c), "is_migrated_data": F.lit(True), "migrated_date": now, "last_track_date": tracked}


# Where each target departs from the rule, its text lengths and its defaults.
CLEANING = {
    "country": Cleaning(
        sources={
            "country_code": "CODE",
            "country_name_en": "NAME",
            "country_name_fr": "NAME",
            "translate_code": "INTL_CODE",
            "online_id": "ID",
        },
        lengths={"country_code": 3, "country_name_en": 100, "country_name_fr": 100, "translate_code": 10},
        empty=("nationality_en", "nationality_fr"),
        made=lambda c, now: {"is_active": F.lit(True)},
    ),
    "region": Cleaning({"uuid": "ID"}),
    "district": Cleaning({"uuid": "ID"}),
    "council": Cleaning({"uuid": "ID", "district_id": "district_ref", "district": "DISTRICT_CODE"}),
    "ward": Cleaning(
        {
            "ward_id": "ID",
            "ward_name": "NAME",
            "is_active": "ACTIVE",
            "uuid": "ID",
            "council_id": "council_ref",
            "district": "district_ref",
            "council": "COUNCIL_CODE",
            "council_name": "COUNCIL_CODE",
        }
    ),
    "registration_center_type": Cleaning(),
    "health_facility": Cleaning(
        sources={
            "health_facility_name": "NAME",
            "health_facility_code": "CODE",
            "is_active": "ACTIVE",
            "uuid": "ID",
            "council_id": "council_ref",
        },
        empty=(
            "health_facility_type_id", "created_by_id", "updated_by_id", "created_by", "deactivated_at",
            "deactivated_by", "deleted_at", "updated_by", "council_hierarchy_id",
        ),
        made=lambda c, now: {"active": c.yn("ACTIVE"), "created_date": now, "updated_date": now},
    ),
    "registration_center": Cleaning(
        sources={
            "mgt_registration_center_id": "ID",
            "center_code": "CODE",
            "uuid": "ID",
            "region_id": "region_ref",
            "district_id": "district_ref",
            "council_id": "council_ref",
            "ward_id": "ward_ref",
            "health_facility_id": "health_facility_ref",
            "registration_center_type_id": "registration_center_type_ref",
        },
        made=lambda c, now: {
            "is_head_office": F.coalesce(c["HEAD_OFFICE"] == "Y", F.lit(False)),
            "activated_at": now,
        },
    ),
    "birth_certificate": Cleaning(
        sources={"notification_no": "NOTIFICATION_NUMBER", "last_printed_date": "FIRST_PRINTED_DATE"},
        lengths={
            "provided_pin_no": 20, "old_pin_no": 20, "notification_no": 20, "first_name": 50, "middle_name": 50,
            "last_name": 50, "other_name": 100, "jamii_no": 50, "sex_code": 10, "place_of_birth_name": 10,
            "facility_name": 100,
        },
        defaults={
            "region_birth_name": "Unknown Region",
            "district_birth_name": "Unknown District",
            "ward_birth_name": "Unknown Ward",
            "country_birth_name": "Tanzania",
            "place_of_birth_name": "Hospital",
            "registrar_name": "System Migrated",
            "certificate_status_id": 1,
            "printed_count": 0,
        },
        empty=("attachment",),
        made=_certificate_made,
        optional_sources=True,
    ),
}


def transform_of(target: str, load_ts: str) -> Transform:
    """The cleaning transform of one of the nine targets; resolved keys are expected as ``<table>_ref``."""
    return clean_table(TARGET_SCHEMAS[target], CLEANING[target], load_ts)


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(text: str) -> T.StructType:
    """A schema from ``name type, ...``, without a session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


AUDIT = "created_at timestamp_ntz, updated_at timestamp_ntz, deleted boolean"

# Target columns and their types.
TARGET_SCHEMAS = {
    "country": _schema(
        "country_code string, country_name_en string, country_name_fr string, nationality_en string,"
        " nationality_fr string, translate_code string, is_active boolean, online_id bigint"
    ),
    "region": _schema(
        f"code string, name string, post_code string, intl_codes string, active boolean, uuid string, {AUDIT}"
    ),
    "district": _schema(
        f"code string, name string, post_code string, active boolean, uuid string, region_id bigint, {AUDIT}"
    ),
    "council": _schema(
        "code string, name string, post_code string, mvc_uuid string, active boolean, uuid string,"
        f" district_id bigint, district string, {AUDIT}"
    ),
    "ward": _schema(
        "ward_id bigint, code string, ward_name string, post_code string, is_active boolean, active boolean,"
        f" uuid string, council_id bigint, district bigint, council string, council_name string, {AUDIT}"
    ),
    "registration_center_type": _schema(f"id bigint, code string, description string, {AUDIT}"),
    "health_facility": _schema(
        "health_facility_name string, health_facility_code string, health_facility_type_id bigint,"
        " is_active boolean, created_date timestamp_ntz, created_by_id bigint, updated_date timestamp_ntz,"
        " updated_by_id bigint, active string, code string, created_by string, deactivated_at timestamp_ntz,"
        " deactivated_by string, deleted_at timestamp_ntz, name string, post_code bigint, updated_by string,"
        f" uuid string, council_id bigint, council_hierarchy_id bigint, {AUDIT}"
    ),
    "registration_center": _schema(
        "mgt_registration_center_id bigint, code string, center_code string, name string,"
        " registration_facility boolean, printing_facility boolean, active boolean, head_office string,"
        " is_head_office boolean, uuid string, region_id bigint, district_id bigint, council_id bigint,"
        f" ward_id bigint, health_facility_id bigint, registration_center_type_id bigint, {AUDIT},"
        " activated_at timestamp_ntz"
    ),
}

_CERTIFICATE_NUMBERS = {n for n in CERTIFICATE_FIELDS if n.endswith("_id")} | {"printed_count"}
_CERTIFICATE_MOMENTS = {n for n in CERTIFICATE_FIELDS if n.endswith("_date")}


def _certificate_type(name: str) -> T.DataType:
    if name == "is_migrated_data":
        return T.BooleanType()
    if name in _CERTIFICATE_NUMBERS:
        return T.LongType()
    return T.TimestampNTZType() if name in _CERTIFICATE_MOMENTS else T.StringType()


CERTIFICATE_SCHEMA = T.StructType([T.StructField(n, _certificate_type(n)) for n in CERTIFICATE_FIELDS])
TARGET_SCHEMAS["birth_certificate"] = CERTIFICATE_SCHEMA


def by_code(*pairs: tuple[str, str]) -> tuple[ForeignKey, ...]:
    return tuple(ForeignKey(code, table, f"{table}_ref") for code, table in pairs)


# The codes of a registration center and the tables that know them.
CENTER_KEYS = by_code(
    ("REGION_CODE", "region"),
    ("DISTRICT_CODE", "district"),
    ("COUNCIL_CODE", "council"),
    ("WARD_CODE", "ward"),
    ("HEALTH_FACILITY_CODE", "health_facility"),
    ("REG_CENTER_TYPE_CODE", "registration_center_type"),
)


# The code columns of a birth and the lookups that know them.
BIRTH_KEYS = by_code(
    ("REGION_CODE", "region"),
    ("DISTRICT_CODE", "district"),
    ("WARD_CODE", "ward"),
    ("COUNTRY_CODE", "country"),
    ("FACILITY_CODE", "health_facility"),
    ("PLACE_OF_BIRTH_CODE", "place_of_birth"),
)

# Columns that may hold the code of a parent place, in the order they are asked.
PARENT_COLUMNS = {
    "district": {"region": ("REGION_ID", "REGION_CODE", "region_id", "region_code")},
    "council": {"district": ("DISTRICT_ID", "DISTRICT_CODE", "district_id", "district_code")},
    "ward": {
        "council": ("COUNCIL_ID", "COUNCIL_CODE", "council_id", "council_code"),
        "district": ("DISTRICT_ID", "DISTRICT_CODE", "district_id", "district_code"),
    },
}


def birth_lookups(tables: Relations) -> dict[str, DataFrame | None]:
    """The lookups of births over the target tables that are there; the others give none."""
    return build_lookups(tables, BIRTH_LOOKUPS)


def births_by_code(source: DataFrame, lookups: Mapping[str, DataFrame | None]) -> DataFrame:
    """Births with the ids of their places put where the certificate transform reads them."""
    resolved = resolve_codes(source, BIRTH_KEYS, lookups)
    places = {"region": "REGION_BIRTH_ID", "district": "DISTRICT_BIRTH_ID", "ward": "WARD_BIRTH_ID", "country": "COUNTRY_BIRTH_ID",
              "health_facility": "FACILITY_ID", "place_of_birth": "PLACE_OF_BIRTH_ID"}
    return resolved.withColumns({column: F.col(f"{name}_ref") for name, column in places.items()}).drop(*(f"{name}_ref" for name in places))


def with_parent_codes(source: DataFrame, target: str) -> DataFrame:
    """``<parent>_any``: the first column that holds a code of the parent, of those the source has."""
    c = Columns(source)
    return source.withColumns({f"{parent}_any": c.first_present(*names) for parent, names in PARENT_COLUMNS[target].items()})


def resolved_by_any_code(source: DataFrame, target: str, lookups: Mapping[str, DataFrame | None]) -> DataFrame:
    """``<parent>_ref`` beside each parent's code; NULL where the code is unknown or the lookup is not there."""
    keys = [ForeignKey(f"{parent}_any", parent, f"{parent}_ref") for parent in PARENT_COLUMNS[target]]
    return resolve_codes(with_parent_codes(source, target), keys, lookups)


def civil_plan(tables: Relations, load_ts: str, mode: str = "skip-existing") -> list[TableLoad]:
    """The nine loads in order, each after the tables whose codes it resolves."""

    def load(table, priority, source, keys=("code",), fks=(), lookup=None, after=()):
        return TableLoad(
            table_id=table, source=lambda spark: source(tables), keys=keys, transform=transform_of(table, load_ts),
            mode=mode, schema=TARGET_SCHEMAS[table], priority=priority, foreign_keys=fks, depends_on=after,
            lookup=LookupSpec(table, *lookup) if lookup else None, description=table.replace("_", " "),
        )

    def plain(name):
        return lambda frames: lookup_source(frames, name)

    ids = ("code", "uuid")
    council, district = ("COUNCIL_CODE", "council"), ("DISTRICT_CODE", "district")
    return [
        load("country", 1, plain("country"), keys=("country_code",)),
        load("registration_center_type", 2, plain("registration_center_type"), lookup=("code", "id")),
        load("region", 3, plain("region"), lookup=ids),
        load("district", 4, district_source, lookup=ids, after=("region",)),
        load("council", 5, council_source, lookup=ids, fks=by_code(district)),
        load("ward", 6, ward_source, lookup=("code", "ward_id"), fks=by_code(council, district)),
        load("health_facility", 7, health_facility_source, lookup=ids, fks=by_code(council)),
        load("registration_center", 8, registration_center_source, fks=CENTER_KEYS),
        load("birth_certificate", 10, birth_source, keys=("provided_pin_no",),
             after=("country", "region", "district", "ward", "health_facility")),
    ]
