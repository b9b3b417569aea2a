"""Reference data: provinces, alias lists, canonical fields."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

CANONICAL = ("raw_id", "name", "address", "city", "province", "postal_code", "latitude", "longitude", "phone", "email")
SPAIN = (36.0, 43.8, -9.3, 4.3)

# Province, postal prefix, latitude from .. to, longitude from .. to (None: the Spain box holds).
PROVINCES = [
    ("A CORUÑA", None, 42.0, 43.2, -9.5, -7.6),
    ("ALBACETE", "02", 38.1, 40.0, -4.3, -0.8),
    ("ALICANTE", "03", 37.5, 39.2, -1.9, -0.2),
    ("ALMERÍA", "04", 36.2, 37.7, -3.8, -1.5),
    ("BADAJOZ", "06", 37.6, 40.0, -7.9, -4.7),
    ("BARCELONA", "08", 40.9, 42.4, 1.2, 3.0),
    ("BURGOS", "09", 40.6, 43.2, -4.4, -2.3),
    ("CANTABRIA", "39", 42.8, 43.6, -4.0, -3.0),
    ("CASTELLÓN", "12", 39.6, 41.0, -1.2, 0.7),
    ("CEUTA", "51", 35.8, 36.1, -5.5, -5.2),
    ("CIUDAD REAL", "13", 38.3, 40.0, -5.3, -2.9),
    ("CUENCA", "16", 39.6, 41.0, -4.1, -1.8),
    ("CÁCERES", "10", None, None, None, None),
    ("CÁDIZ", "11", 35.8, 37.3, -6.7, -5.2),
    ("CÓRDOBA", "14", 37.2, 39.0, -5.5, -3.2),
    ("GIRONA", "17", 41.7, 42.5, 2.0, 3.4),
    ("GRANADA", "18", 36.5, 38.1, -4.8, -2.3),
    ("GUADALAJARA", "19", 39.8, 41.5, -4.6, -1.9),
    ("GUIPÚZCOA", "20", 42.9, 43.5, -2.8, -1.4),
    ("HUELVA", "21", None, None, None, None),
    ("HUESCA", "22", None, None, None, None),
    ("JAÉN", "23", 37.4, 39.0, -4.8, -2.4),
    ("LA CORUÑA", "15", None, None, None, None),
    ("LA RIOJA", "26", 41.6, 42.8, -3.4, -1.8),
    ("LAS PALMAS", "35", 27.5, 28.5, -16.1, -15.0),
    ("LEÓN", "24", 41.6, 43.4, -6.9, -4.8),
    ("LLEIDA", "25", 41.2, 43.1, 0.1, 2.0),
    ("LUGO", "27", 42.2, 43.4, -9.0, -7.3),
    ("MADRID", "28", 39.8, 41.4, -4.5, -2.5),
    ("MELILLA", "52", 35.2, 35.5, -3.4, -3.1),
    ("MURCIA", "30", 37.1, 38.7, -2.5, -0.7),
    ("MÁLAGA", "29", 36.2, 37.6, -5.3, -3.2),
    ("NAVARRA", "31", 42.0, 43.2, -3.3, -1.0),
    ("OURENSE", "32", 41.6, 42.8, -8.9, -7.1),
    ("PALENCIA", "34", 41.4, 42.7, -5.9, -3.9),
    ("PALMA", "07", 39.2, 39.8, 2.4, 3.2),
    ("PONTEVEDRA", "36", 41.6, 42.8, -9.1, -7.8),
    ("SALAMANCA", "37", None, None, None, None),
    ("SEGOVIA", "40", 40.3, 41.7, -4.8, -3.2),
    ("SEVILLA", "41", 36.5, 38.5, -7.2, -4.2),
    ("SORIA", "42", 40.6, 42.5, -4.1, -2.0),
    ("TARRAGONA", "43", 40.7, 41.7, 0.4, 1.7),
    ("TERUEL", "44", None, None, None, None),
    ("TOLEDO", "45", 39.0, 40.7, -5.2, -3.0),
    ("VALENCIA", "46", 38.5, 41.0, -1.7, 0.2),
    ("VALLADOLID", "47", 40.8, 42.5, -5.4, -3.5),
    ("VIZCAYA", "48", 42.6, 43.5, -3.7, -2.5),
    ("ZAMORA", "49", None, None, None, None),
    ("ZARAGOZA", "50", None, None, None, None),
    ("ÁLAVA", "01", 42.2, 43.3, -3.8, -2.3),
    ("ÁVILA", "05", 39.8, 41.5, -6.2, -4.3),
]
PROVINCE_SCHEMA = "province string, postal_prefix string, lat_min double, lat_max double, lon_min double, lon_max double, is_official boolean"


def province_dim(spark: SparkSession) -> DataFrame:
    """All provinces, 51 rows; one of them has a box but is no official name."""
    return spark.createDataFrame([(*p, p[1] is not None) for p in PROVINCES], PROVINCE_SCHEMA)


# Names that each canonical field goes by, for fuzzy mapping.
ALIASES = {
    "raw_id": ("raw_id", "id", "codigo", "code", "identifier", "station_id"),
    "name": ("name", "nom", "nome", "nombre"),
    "address": ("address", "adreca", "enderezo", "direccion"),
    "city": ("city", "ciutat", "concello", "poblacion"),
    "province": ("province", "provincia"),
    "postal_code": ("postal_code", "codi_postal", "codigo_postal", "cp", "zip", "zip_code"),
    "latitude": ("latitude", "latitud", "lat"),
    "longitude": ("longitude", "longitud", "lon", "lng"),
    "phone": ("phone", "telefon", "telefono", "tel"),
    "email": ("email", "correo", "mail", "e_mail"),
}


@dataclass(frozen=True)
class MappingSpec:
    """How one source's records become canonical fields: the first truthy name of each list wins."""

    source: str
    prefix: str
    formats: tuple[str, ...]
    wrappers: tuple[str, ...]
    fan_out_wrapper: str
    single: tuple[str, str]
    fields: dict[str, tuple[str, ...]] = field(hash=False)


# The three sources' field names.
_SPECS = [
    MappingSpec(
        "catalunya", "CAT", ("xml", "json"), ("stations",), "stations", ("id", "nom"),
        {"raw_id": ("id",), "name": ("nom",), "address": ("adreca",), "city": ("ciutat",), "province": ("provincia",), "postal_code": ("codi_postal",),
         "latitude": ("latitud",), "longitude": ("longitud",), "phone": ("telefon",), "email": ("email",)},
    ),
    MappingSpec(
        "valencia", "VAL", ("json",), ("estaciones", "stations"), "estaciones", ("codigo", "nombre"),
        {"raw_id": ("codigo", "id", "station_id"), "name": ("nombre", "name"), "address": ("direccion", "address"), "city": ("poblacion", "ciudad", "city"),
         "province": ("provincia", "province"), "postal_code": ("codigo_postal", "cp", "postal_code"), "latitude": ("latitud", "latitude"),
         "longitude": ("longitud", "longitude"), "phone": ("telefono", "phone"), "email": ("correo", "email")},
    ),
    MappingSpec(
        "galicia", "GAL", ("csv", "json"), ("stations", "estaciones"), "stations", ("id", "nome"),
        {"raw_id": ("id", "codigo", "station_id"), "name": ("nome", "nombre", "name"), "address": ("enderezo", "direccion", "address"),
         "city": ("concello", "poblacion", "ciudad", "city"), "province": ("provincia", "province"), "postal_code": ("cp", "codigo_postal", "postal_code"),
         "latitude": ("lat", "latitud", "latitude"), "longitude": ("lon", "longitud", "longitude"), "phone": ("telefono", "phone"), "email": ("email", "correo")},
    ),
]
REGISTRY: dict[str, MappingSpec] = {s.source: s for s in _SPECS}


def register(spec: MappingSpec) -> MappingSpec | None:
    """Adds a source; the one that it replaces is returned."""
    if not isinstance(spec, MappingSpec):
        raise TypeError("a MappingSpec is needed")
    name = spec.source.strip().lower()
    old, REGISTRY[name] = REGISTRY.get(name), spec
    return old


def is_supported(source: str) -> bool:
    return source.strip().lower() in REGISTRY


def supported_sources() -> list[str]:
    return sorted(REGISTRY)
