"""All thresholds of the workflows, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Scan:
    """Which periods become candidate bins. ``nms_radius`` None means ``window``."""

    min_copy_number: float = 100.0
    min_blocks: int = 5
    min_single_block_copy_number: float = 300.0
    min_period_length: int = 150
    window: int = 5
    nms_radius: int | None = None
    name_prefix: str = "cand"

    @property
    def radius(self) -> int:
        return self.window if self.nms_radius is None else self.nms_radius


@dataclass(frozen=True)
class Peeling:
    """How the loci of a bin are peeled into clusters, and clusters into consensus sequences."""

    min_identity: float = 0.8
    max_gap_fraction: float = 0.5
    min_cluster_size: int = 3
    max_rounds: int = 15
    anchor_length: int = 21
    anchor_offsets: tuple[float, ...] = (0.5, 0.25, 0.75, 0.1, 0.9)
    require_unique_anchor: bool = False
    tie_seed: int = 1


@dataclass(frozen=True)
class Comparing:
    """When two consensus sequences count as similar, or one as a multiple of the other."""

    min_identity: float = 0.7
    min_coverage: float = 0.85
    max_copies: int = 6
    n_shuffles: int = 20
    max_null_passes: int = 0
    shuffle_seed: int = 1
    shuffle_mode: str = "mono"
    skip_margin: float = 0.0


@dataclass(frozen=True)
class Screening:
    """What counts as a likely satellite region, and as one that the library explains."""

    min_copy_number: float = 100.0
    min_single_block_copy_number: float = 300.0
    min_period_length: int = 150
    merge_distance: int = 2000
    min_coverage_fraction: float = 0.5
    family: str | None = "Satellite"


@dataclass(frozen=True)
class Params:
    scan: Scan = field(default_factory=Scan)
    peeling: Peeling = field(default_factory=Peeling)
    comparing: Comparing = field(default_factory=Comparing)
    screening: Screening = field(default_factory=Screening)
    min_total_copy_number: float = 500.0
    classification: str = "Satellite"
    double_sequences: bool = True
    top_n: int = 20


#: Sections of a configuration file, the group of parameters each fills, and names that differ there.
SECTIONS: dict[str, tuple[str, dict[str, str]]] = {
    "candidate_scan": ("scan", {}),
    "cluster_ranking": ("peeling", {"min_cluster_identity": "min_identity"}),
    "cross_cluster_comparison": ("comparing", {"null_test_skip_margin": "skip_margin"}),
    "satellite_screen": ("screening", {}),
}
#: Single values by section and name, and what they are called here.
SINGLE: dict[tuple[str, str], str] = {
    ("copy_number_filter", "min_total_copy_number"): "min_total_copy_number",
    ("visualization", "top_n"): "top_n",
    ("known_repeat_screen", "double_sequences"): "double_sequences",
}


def from_mapping(config: dict) -> Params:
    """Parameters from a configuration as nested dictionaries (a YAML file, say); what it leaves out keeps its default.

    Settings of other tools (paths, shards, resources) are passed over; a value of a wrong kind is an error.
    """
    made: dict = {}
    for section, (group, renamed) in SECTIONS.items():
        kind = type(getattr(Params(), group))
        known = {f.name: f for f in fields(kind)}
        own = {}
        for name, value in (config.get(section) or {}).items():
            name = renamed.get(name, name)
            if name in known:
                default = getattr(kind(), name)
                if isinstance(default, (int, float)) and not isinstance(default, bool) and not isinstance(value, (int, float)):
                    raise ValueError(f"{section}.{name} must be a number, not {value!r}")
                own[name] = tuple(value) if isinstance(value, list) else value
        made[group] = kind(**own)
    for (section, name), here in SINGLE.items():
        if name in (config.get(section) or {}):
            made[here] = config[section][name]
    return Params(**made)
