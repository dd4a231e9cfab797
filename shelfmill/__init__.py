"""Shop-page extraction on Spark: pages in, campaigns and products out."""

from .rules import DEFAULT_PROFILE, Sel, SiteProfile

__all__ = ["DEFAULT_PROFILE", "Sel", "SiteProfile"]
