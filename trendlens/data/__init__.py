"""Plain data files shipped with the package."""
