"""The five reference dimensions, each as one specification; ``operators.reference`` runs them all."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from skyops.functions import envelope
from skyops.operators.quality import Rule, present

TEXT, CODE, NUMBER = "text", "code", "number"


@dataclass(frozen=True)
class EntitySpec:
    """``columns`` maps each column to its path in a record and how it is cleaned; ``required`` is in reason order."""

    name: str
    record_path: str
    columns: dict[str, tuple[str, str]]
    keys: tuple[str, ...]
    required: tuple[str, ...]
    quarantine_raw: tuple[str, ...] = field(default=())

    @property
    def resource(self) -> str:
        return self.record_path.split(".")[0]

    @property
    def record(self) -> T.StructType:
        return envelope.struct_of({
            path: T.DoubleType() if kind == NUMBER else T.StringType() for path, kind in self.columns.values()
        })

    @property
    def rules(self) -> list[Rule]:
        return [present(c, reason=f"{c} missing or invalid") for c in self.required]

    @property
    def raw_columns(self) -> list[str]:
        return [f"{c}_raw" for c in (self.quarantine_raw or self.columns)]


# Record paths, field paths, keys and required columns of the reference payloads.
AIRPORTS = EntitySpec(
    "airports",
    "AirportResource.Airports.Airport",
    {
        "airport_code": ("AirportCode", CODE),
        "airport_name": ("Names.Name.$", TEXT),
        "city_code": ("CityCode", CODE),
        "country_code": ("CountryCode", CODE),
        "latitude": ("Position.Coordinate.Latitude", NUMBER),
        "longitude": ("Position.Coordinate.Longitude", NUMBER),
        "location_type": ("LocationType", TEXT),
        "utc_offset": ("UtcOffset", TEXT),
        "time_zone_id": ("TimeZoneId", TEXT),
    },
    keys=("airport_code",),
    required=("airport_code", "airport_name", "city_code", "country_code"),
)
AIRLINES = EntitySpec(
    "airlines",
    "AirlineResource.Airlines.Airline",
    {
        "airline_id": ("AirlineID", CODE),
        "airline_id_icao": ("AirlineID_ICAO", CODE),
        "airline_name": ("Names.Name.$", TEXT),
    },
    keys=("airline_id",),
    required=("airline_id", "airline_name"),
)
AIRCRAFT = EntitySpec(
    "aircraft",
    "AircraftResource.AircraftSummaries.AircraftSummary",
    {
        "aircraft_code": ("AircraftCode", CODE),
        "aircraft_name": ("Names.Name.$", TEXT),
        "airline_equip_code": ("AirlineEquipCode", CODE),
    },
    keys=("aircraft_code",),
    required=("aircraft_code", "aircraft_name"),
)
CITIES = EntitySpec(
    "cities",
    "CityResource.Cities.City",
    {
        "city_code": ("CityCode", CODE),
        "country_code": ("CountryCode", CODE),
        "city_name": ("Names.Name.$", TEXT),
        "utc_offset": ("UtcOffset", TEXT),
        "time_zone_id": ("TimeZoneId", TEXT),
    },
    keys=("city_code", "country_code"),
    required=("city_code", "country_code", "city_name"),
    quarantine_raw=("city_code", "country_code", "city_name"),
)
COUNTRIES = EntitySpec(
    "countries",
    "CountryResource.Countries.Country",
    {
        "country_code": ("CountryCode", CODE),
        "country_name": ("Names.Name.$", TEXT),
    },
    keys=("country_code",),
    required=("country_code", "country_name"),
)
ENTITIES = {spec.name: spec for spec in (AIRPORTS, AIRLINES, AIRCRAFT, CITIES, COUNTRIES)}
