"""Plain configuration objects (no framework instantiation).

They mirror the original pipeline's configuration vocabulary: dimensions and
coordinates with alternative names, variables with scaling flags, models
(``hr``/``lr`` and their invariant twins) and the selection block.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass
class Dimension:
    name: str
    alternative_names: list[str] = field(default_factory=list)
    hr_only: bool = False
    chunksize: int | str = "auto"


@dataclass
class Variable:
    name: str
    alternative_names: list[str] = field(default_factory=list)
    path: Any = None
    is_west_negative: bool = False
    transform: list[str] | str | None = None
    invariant: bool = False
    apply_standardize: bool = True
    apply_normalize: bool = False

    def transforms(self) -> list[str]:
        """Transform list; ``None`` means none, a bare string is one item."""
        if self.transform is None:
            return []
        if isinstance(self.transform, str):
            return [self.transform]
        return list(self.transform)


@dataclass
class Model:
    name: str
    info: str = ""
    climate_variables: list[Variable] = field(default_factory=list)
    hr_ref: Variable | None = None


@dataclass
class IndexRange:
    first_index: int
    last_index: int


@dataclass
class Spatial:
    scale_factor: int
    x: IndexRange
    y: IndexRange


@dataclass
class TimeSelect:
    start: str
    end: str
    test_years: list[int]
    validation_years: list[int]


@dataclass
class Loader:
    batch_size: int = 4
    randomize: bool = True
    seed: int = 0


@dataclass
class DataConfig:
    output_path: str
    climate_models: list[Model]
    dims: list[Dimension]
    coords: list[Dimension]
    time: TimeSelect | None = None
    spatial: Spatial | None = None
    loader: Loader = field(default_factory=Loader)


# Model names whose fields are regridded and coarsened (the rest are cropped).
LR_MODELS_HINT = ("lr", "lr_invariant")


def default_dims() -> list[Dimension]:
    # Canonical dimension names and their alternatives.
    return [
        Dimension("time", ["forecast_initial_time", "Time", "Times", "times"]),
        Dimension("rlat", ["rotated_latitude"], hr_only=True),
        Dimension("rlon", ["rotated_longitude"], hr_only=True),
    ]


def default_coords() -> list[Dimension]:
    # Canonical coordinate names and their alternatives.
    return [
        Dimension("lat", ["latitude", "Lat", "Latitude"]),
        Dimension("lon", ["longitude", "Long", "Lon", "Longitude"]),
    ]


def _dims(items) -> list[Dimension]:
    return [Dimension(d["name"], list(d.get("alternative_names") or []), bool(d.get("hr_only", False)),
                      d.get("chunksize", "auto")) for d in (items or [])]


def _variable(v: dict) -> Variable:
    return Variable(name=v["name"], alternative_names=list(v.get("alternative_names") or []),
                    path=v.get("path"), is_west_negative=bool(v.get("is_west_negative", False)),
                    transform=v.get("transform"), invariant=bool(v.get("invariant", False)),
                    apply_standardize=bool(v.get("apply_standardize", True)),
                    apply_normalize=bool(v.get("apply_normalize", False)))


def config_from_dict(raw: dict) -> DataConfig:
    """Build a DataConfig from the YAML layout (``_target_`` keys are ignored)."""
    models = []
    for m in raw.get("climate_models") or []:
        ref = m.get("hr_ref")
        models.append(Model(name=m["name"], info=m.get("info", ""),
                            climate_variables=[_variable(v) for v in m.get("climate_variables") or []],
                            hr_ref=_variable(ref) if ref else None))
    select = raw.get("select") or {}
    t = select.get("time") or {}
    rng = t.get("range") or {}
    time = TimeSelect(rng.get("start"), rng.get("end"), list(t.get("test_years") or []),
                      list(t.get("validation_years") or [])) if t else None
    sp = select.get("spatial")
    spatial = None
    if sp:
        spatial = Spatial(int(sp["scale_factor"]),
                          IndexRange(int(sp["x"]["first_index"]), int(sp["x"]["last_index"])),
                          IndexRange(int(sp["y"]["first_index"]), int(sp["y"]["last_index"])))
    ld = raw.get("loader") or {}
    loader = Loader(int(ld.get("batch_size", 4)), bool(ld.get("randomize", True)),
                    int(ld.get("seed", 0)))
    return DataConfig(output_path=raw.get("output_path", ""), climate_models=models,
                      dims=_dims(raw.get("dims")) or default_dims(),
                      coords=_dims(raw.get("coords")) or default_coords(),
                      time=time, spatial=spatial, loader=loader)


def load_config(path: str) -> DataConfig:
    """Read a YAML configuration file (same keys as the original pipeline's config)."""
    import yaml
    with open(path) as fh:
        return config_from_dict(yaml.safe_load(fh))


def load_settings(path: str) -> dict:
    """Read a YAML file of plain settings (source cuts and lead unfolding)."""
    import yaml
    with open(path) as fh:
        return yaml.safe_load(fh)
