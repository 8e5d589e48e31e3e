"""Settings of a run: paths, namespaces, the period, thresholds and which steps run."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

YES, NO = frozenset({"y", "yes", "1", "true"}), frozenset({"n", "no", "0", "false"})
BACKENDS = ("duckdb", "postgresql")


@dataclass(frozen=True)
class Thresholds:
    """Limits of the segmentation. All comparisons with them are strict where their use says so."""

    stop_sog_kn: float = 1.0
    stop_distance_m: float = 250.0
    stop_gap_s: float = 5400.0
    stop_points: int = 10
    stop_duration_s: int = 600
    merge_distance_m: float = 50.0
    merge_gap_s: float = 3600.0
    stop_area_m2: float = 5_000_000.0
    point_buffer_deg: float = 1e-5
    traj_speed_kn: float = 50.0
    traj_gap_s: float = 3600.0
    traj_points: int = 10
    hull_ratio: float = 0.2
    vessel_points: int = 10


def parse_bool(value: str | None, name: str = "setting") -> bool | None:
    """None if unset; else one of the accepted words, or ValueError."""
    if value is None:
        return None
    word = value.strip().lower()
    if word in YES or word in NO:
        return word in YES
    raise ValueError(f"{name}: '{value}' is neither {'/'.join(sorted(YES))} nor {'/'.join(sorted(NO))}")


def answer(text: str, default: bool) -> bool:
    """A typed answer; an empty or unknown one gives the default."""
    word = text.strip().lower()
    return True if word in YES else False if word in NO else default


def run_step(env: Mapping[str, str], name: str, fallback: str | None = None, default: bool = True) -> bool:
    """Whether a step runs: its own variable, then the fallback's, then the default."""
    for key in (name, fallback):
        if key and (said := parse_bool(env.get(key), key)) is not None:
            return said
    return default


def ask_step(env: Mapping[str, str], name: str, question: str, fallback: str | None = None, default: bool = True, ask=input) -> bool:
    """As run_step, but where no variable says anything, a person is asked."""
    for key in (name, fallback):
        if key and (said := parse_bool(env.get(key), key)) is not None:
            return said
    return answer(ask(f"{question} [{'Y/n' if default else 'y/N'}]: "), default)


def ask_period(question: str, start: date | None = None, end: date | None = None, available: tuple[date, date] | None = None, ask=input, tell=print) -> tuple[date | None, date | None]:
    """A period that a person types, the given one if nothing is typed; what cannot be read is asked for again."""
    if available:
        first, last = available
        tell(f"Available: {first:%d/%m/%Y} - {last:%d/%m/%Y} ({(last - first).days + 1} days). 30 days at most are recommended for a run.")
    while True:
        text = ask(f"{question}: ").strip()
        if not text:
            return start, end
        try:
            return parse_date_range(text)
        except ValueError as e:
            tell(str(e))


def parse_date(text: str) -> date:
    """YYYY-MM-DD, YYYY/MM/DD, DD-MM-YYYY or DD/MM/YYYY."""
    for mark in "-/":
        parts = [x.strip() for x in text.strip().split(mark)]
        if len(parts) == 3 and 4 in (len(parts[0]), len(parts[2])):
            year, month, day = parts if len(parts[0]) == 4 else parts[::-1]
            return date(int(year), int(month), int(day))
    raise ValueError(f"'{text}' is no date: write YYYY-MM-DD, YYYY/MM/DD, DD-MM-YYYY or DD/MM/YYYY")


def parse_date_range(text: str) -> tuple[date | None, date | None]:
    """Two dates with ' - ', ' to ' or ',' between them, or one date for both; empty: no limits."""
    text = text.strip()
    if not text:
        return None, None
    for mark in (" - ", " to ", ","):
        if mark in text:
            first, last = (parse_date(x) for x in text.split(mark, 1))
            break
    else:
        first = last = parse_date(text)
    if first > last:
        raise ValueError(f"the period starts on {first}, after its end on {last}")
    return first, last


@dataclass(frozen=True)
class PipelineConfig:
    ais_path: str = ""
    warehouse: str = ""
    schema: str = "wakeline"
    ls_schema: str | None = None
    cs_schema: str | None = None
    backend: str = "duckdb"
    start: date | None = None
    end: date | None = None
    zoom: int = 21
    skip_z21: bool = False
    partition_by_day: bool = True
    only_mmsi: int | None = None
    keep_errors: bool = False
    drop_ls: bool = False
    drop_cs: bool = False
    create_schema: bool = True
    create_tables: bool = True
    point_tables: bool = True
    construct: bool = True
    transform: bool = True
    thresholds: Thresholds = field(default_factory=Thresholds)

    def __post_init__(self) -> None:
        if self.backend.lower() not in BACKENDS:
            raise ValueError(f"backend '{self.backend}' is not one of {', '.join(BACKENDS)}")
        object.__setattr__(self, "backend", self.backend.lower())
        if self.start and self.end and self.start > self.end:
            raise ValueError("the period's start is after its end")

    @property
    def lines(self) -> str:
        """The namespace of points, lines and polygons."""
        return self.ls_schema or self.schema

    @property
    def cells(self) -> str:
        """The namespace of cells; several can share one namespace of lines."""
        return self.cs_schema or self.schema

    @staticmethod
    def from_env(env: Mapping[str, str] = os.environ) -> PipelineConfig:
        """Settings from environment variables; the backend's schema and AIS_DATA_PATH have to be there.

        DB_BACKEND names the backend whose variables count; ETL_* switch the steps."""
        backend = env.get("DB_BACKEND", "duckdb").lower()
        kind = backend.upper()
        for name in (f"{kind}_SCHEMA", "AIS_DATA_PATH"):
            if not env.get(name):
                raise ValueError(f"{name} is not set")
        day = lambda name: parse_date(env[name]) if env.get(name) else None
        return PipelineConfig(
            ais_path=env["AIS_DATA_PATH"],
            warehouse=env.get(f"{kind}_PATH", ""),
            schema=env[f"{kind}_SCHEMA"],
            ls_schema=env.get(f"{kind}_LS_SCHEMA") or None,
            cs_schema=env.get(f"{kind}_CS_SCHEMA") or None,
            backend=backend,
            start=day("AIS_START_DATE"),
            end=day("AIS_END_DATE"),
            skip_z21=run_step(env, "SKIP_Z21", default=False),
            keep_errors=run_step(env, "KEEP_ERRORS", default=False),
            drop_ls=run_step(env, "ETL_DROP_LS", "ETL_DROP", False),
            drop_cs=run_step(env, "ETL_DROP_CS", "ETL_DROP", False),
            create_schema=run_step(env, "ETL_CREATE_SCHEMA"),
            create_tables=run_step(env, "ETL_CREATE_TABLES"),
            point_tables=run_step(env, "ETL_CREATE_POINTS"),
            construct=run_step(env, "ETL_CONSTRUCT"),
            transform=run_step(env, "ETL_TRANSFORM"),
        )


def format_eta(seconds: float) -> str:
    """Hours, minutes and seconds of what is left."""
    whole = max(0, int(seconds))
    return f"{whole // 3600:02d}:{whole // 60 % 60:02d}:{whole % 60:02d}"
