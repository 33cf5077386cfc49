"""Parameters of the pipeline, with the defaults of airborne LiDAR tiles of 1:20 000 map sheets."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DownloadConfig:
    enabled: bool = False
    use_aoi: bool = True
    most_recent: bool = True
    min_year: int | None = None
    map_tile: str = "093"
    letter: str = "h"
    year: int = 2020
    tile_numbers: tuple[str, ...] | str = ("040",)
    subdivisions: tuple[str, ...] | str = "all"
    parallel: bool = True
    max_workers: int = 8


@dataclass(frozen=True)
class PipelineConfig:
    """Lengths are in metres, angles in degrees.

    edge: "core" crops the canopy raster to a chunk's core before trees are found, so that trees end at seams; "halo"
    finds trees on the raster with its halo and keeps those whose apex cell is in the core.
    """

    crs: int = 3005
    chunk_size: float = 100.0
    chunk_buffer: float = 10.0
    resolution: float = 0.15
    hmin: float = 2.0
    hmax: float = 30.0
    min_points: int = 5
    uniqueness: str = "bitmerge"
    bbox_size: float = 100.0
    hillshade_angle: float = 45.0
    hillshade_direction: float = 315.0
    edge: str = "core"
    # interpolation outside the hull: nearest points, power, furthest
    idw_k: int = 3
    idw_power: float = 1.0
    idw_max: float = 50.0
    # canopy: share of hmax of each threshold, radius of the disc that a return stands for, longest triangle edges
    canopy_levels: tuple[float, ...] = (0.0, 0.5, 1.0)
    subcircle: float = 0.2
    max_edge: tuple[float, float] = (0.0, 1.0)
    # treetops and crowns
    lmf_hmin: float = 2.0
    th_tree: float = 2.0
    th_seed: float = 0.45
    th_cr: float = 0.55
    max_cr: int = 10
    # scene analytics
    density_window: float = 100.0
    az_fraction: float = 10.0
    max_dist: float = 100.0
    utc_offset: float = -8.0
    start_day: int = 1
    end_day: int = 365
    start_time: str = "00:00:00"
    end_time: str = "23:59:59"
    time_step_minutes: int = 30
    bins: int = 400
    download: DownloadConfig = field(default_factory=DownloadConfig)

    def halo(self) -> float:
        """The halo that trees need: the configured one, or that of crowns in "halo" mode."""
        return max(self.chunk_buffer, self.max_cr * self.resolution + 2.7) if self.edge == "halo" else self.chunk_buffer
