"""Named queries over the tables of a data folder; importing this registers them."""

from lodestone.plans import code, graphs, listings, lookups, logs, progress, scans, search, sources, statistics, texts  # noqa: F401
