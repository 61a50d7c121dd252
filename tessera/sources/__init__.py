from tessera.sources.tables import TABLE_NAMES, Tables  # noqa: F401
