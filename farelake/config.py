"""Names, fixed values and the configuration of a lake."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Column names, cell spellings and file names of the public
# fare and flight-statistics files and of the curated output.
FARE_COLUMNS = ("year", "month", "company", "origin", "destination", "price", "seats")

OPERATION_COLUMNS = {
    "EMPRESA_SIGLA": "company",
    "EMPRESA_NOME": "companyName",
    "EMPRESA_NACIONALIDADE": "nationality",
    "ANO": "year",
    "MES": "month",
    "AEROPORTO_DE_ORIGEM_SIGLA": "origin",
    "AEROPORTO_DE_DESTINO_SIGLA": "destination",
    "DECOLAGENS": "takeOffs",
    "DISTANCIA_VOADA_KM": "distance",
    "ASSENTOS": "seats",
    "HORAS_VOADAS": "time",
    "PASSAGEIROS_PAGOS": "paidPassengers",
    "PASSAGEIROS_GRATIS": "noPaidPassengers",
}

OPERATION_INTEGERS = (
    "year",
    "month",
    "takeOffs",
    "distance",
    "seats",
    "paidPassengers",
    "noPaidPassengers",
)

CURATED_COLUMNS = (
    "year",
    "month",
    "company",
    "companyName",
    "city",
    "state",
    "destination",
    "priceAVG",
    "seatsAVG",
    "takeOffs",
    "distance",
    "seatsAll",
    "time",
)

# The relations of the processing zone.
# ``year`` is the year a fare's file is of, ``yearCell`` what its own cell says.
# ``unread`` names the cells that hold text but no number; NULL where there are none.
FARE_SCHEMA = (
    "year int, month int, company string, origin string, destination string, "
    "price double, seats int, yearCell int, unread string"
)
OPERATION_SCHEMA = (
    "company string, companyName string, nationality string, year int, month int, "
    "origin string, destination string, takeOffs int, distance int, seats int, "
    "time string, paidPassengers int, noPaidPassengers int, unread string"
)
MEAN_SCHEMA = (
    "year int, month int, company string, origin string, destination string, "
    "priceAVG double, seats bigint"
)
CURATED_SCHEMA = (
    "year int, month int, company string, companyName string, city string, state string, "
    "destination string, priceAVG double, seatsAVG bigint, takeOffs int, distance int, "
    "seatsAll int, time string"
)

PRICE_SENTINEL = "Tarifa-N"
MONTH_FILE = "price{year}/{year}{month:02d}.CSV"

# Keys of the measure, and the two ways to match it with operations: over all
# years at once, or inside one year that is fixed beforehand.
FARE_KEYS = ("year", "month", "company", "origin", "destination")
YEARLY_KEYS = ("month", "company", "destination")


@dataclass(frozen=True)
class LakeConfig:
    """Where the zones are and which slice of them a run is about.

    The three zone roots are URIs every executor can reach (``s3a://``,
    ``hdfs://``, or ``file:`` on one machine).
    """

    landing: str
    processing: str
    curated: str

    years: tuple[int, ...] = (2019, 2020, 2021, 2022)
    months: tuple[int, ...] = tuple(range(1, 13))
    origin: str | None = "SBMO"  # None keeps all origins.

    month_file: str = MONTH_FILE
    operations_dir: str = "statistics"
    airports_dir: str = "icao"
    distances_path: str = "dist"
    # Without a schema each run reads the distance documents twice, once to find it.
    distances_schema: str | None = None
    # Read arrays of objects by ranges, so that many tasks read one large file.
    split_documents: bool = False
    text_options: Mapping[str, str] = field(default_factory=dict)

    price_sentinel: str = PRICE_SENTINEL
    price_grouping: str | None = None
    lenient_ints: bool = False

    # "all": a run replaces each relation whole. "years": it replaces the years
    # above, each exactly, and leaves others as they are.
    replace: str = "all"

    # One table per year, or a single one by year when the pattern names none.
    # Without a format the tables go to the session catalogue. A connector
    # replaces tables whole, so it needs one per year to refresh some years.
    table: str = "data{year}"
    warehouse_format: str | None = None
    warehouse_options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.replace not in ("all", "years"):
            raise ValueError(f"replace must be 'all' or 'years', not {self.replace!r}")
        if not self.years:
            raise ValueError("a run needs at least one year")
        if self.warehouse_format and self.replace == "years" and "{year}" not in self.table:
            raise ValueError("a connector refreshes single years only in a table per year")

    def landing_path(self, name: str) -> str:
        return f"{self.landing.rstrip('/')}/{name}"

    def processing_path(self, name: str) -> str:
        return f"{self.processing.rstrip('/')}/{name}"

    def curated_path(self, name: str) -> str:
        return f"{self.curated.rstrip('/')}/{name}"
