"""Settings of the pipelines: from a flat or sectioned mapping, YAML or INI; unknown keys are left out."""

from __future__ import annotations

import configparser
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields
from pathlib import Path

import yaml


@dataclass(frozen=True)
class Settings:
    """Defaults are fixed values of the operators' semantics."""

    idlimit_px: float = 3.0
    position_match_radius_arcsec: float = 2.0
    min_n_detections: int = 3
    min_catalogs_fraction: float = 1.0
    min_quality: float = 0.2
    maglim_filter_multiplier: float = 1.1
    siglim: float = 5.0
    new_source_siglim: float | None = 1.5
    mag_change_threshold: float = 0.3
    catalogs: tuple[str, ...] = ("atlas@localhost", "gaia", "usno")
    adaptive_nsigma: float = 3.0
    adaptive_percentile: float = 95.0
    enable_adaptive_idlimit: bool = True
    idlimit_min_px: float = 1.0
    idlimit_max_px: float = 8.0
    use_astvar: bool = True
    default_plate_scale_arcsec_per_px: float = 0.33
    magnitude_weight: float = 1.0
    significance_weight: float = 2.0
    consistency_weight: float = 1.5
    isolation_weight: float = 1.0
    lc_shape_weight: float = 1.0
    trail_downweight_factor: float = 3.0
    trail_min_epochs: int = 3
    trail_motion_sigma_min: float = 0.5
    trail_motion_sig_tau: float = 3.0
    trail_score_threshold: float = 0.7
    trail_astsigma_displacement_threshold: float = 3.0
    vsx_filter_enabled: bool = True
    vsx_match_radius_arcsec: float = 2.5
    max_candidates: int = 100
    strategy: str = "blind_multicatalog"
    morphology_max_ellipticity: float = 0.4
    morphology_fwhm_ratio_min: float = 0.5
    morphology_fwhm_ratio_max: float = 2.0
    stacking_enabled: bool = True
    stacking_min_epochs: int = 10
    stacking_max_epochs: int = 20
    stacking_rebuild_interval: int = 5
    stacking_score_threshold: float = 1.0

    @property
    def weights(self) -> dict[str, float]:
        return {"mag": self.magnitude_weight, "sig": self.significance_weight, "cons": self.consistency_weight, "iso": self.isolation_weight, "lc": self.lc_shape_weight, "trail": self.trail_downweight_factor}

    @property
    def trail(self) -> dict[str, float]:
        return {"epochs": self.trail_min_epochs, "sigma": self.trail_motion_sigma_min, "significance": self.trail_motion_sig_tau, "score": self.trail_score_threshold, "displacement": self.trail_astsigma_displacement_threshold}

    @classmethod
    def of(cls, given: Mapping) -> Settings:
        """From a mapping whose values are settings or sections of settings."""
        flat: dict = {}
        for k, v in given.items():
            flat |= v if isinstance(v, Mapping) else {k: v}
        out = {}
        for f in fields(cls):
            if f.name in flat:
                default, v = f.default, flat[f.name]
                if isinstance(default, tuple):
                    v = tuple(p.strip() for p in v.split(",")) if isinstance(v, str) else tuple(v)
                elif isinstance(default, bool) and isinstance(v, str):
                    v = v.strip().lower() in ("1", "true", "yes", "on")
                elif v is not None and default is not None:
                    v = type(default)(v)
                out[f.name] = v
        return cls(**out)

    @classmethod
    def read(cls, path: str) -> Settings:
        text = Path(path).read_text()
        if path.endswith((".yaml", ".yml")):
            return cls.of(yaml.safe_load(text) or {})
        ini = configparser.ConfigParser()
        ini.read_string(text)
        return cls.of({s: dict(ini[s]) for s in ini.sections()})

    def dump(self) -> str:
        return yaml.safe_dump(asdict(self) | {"catalogs": list(self.catalogs)})
