"""Point-in-time forecast reads and maintenance jobs on Spark."""

from hindcast.errors import (
    BatchMixUpError,
    CatalogNotFoundError,
    IncompatibleContractError,
    LakeError,
    MissingBodyError,
    QuarantinedError,
    UnknownProductError,
    UnsupportedSchemaVersionError,
)
from hindcast.reader import ForecastReader

__all__ = [
    "BatchMixUpError",
    "CatalogNotFoundError",
    "ForecastReader",
    "IncompatibleContractError",
    "LakeError",
    "MissingBodyError",
    "QuarantinedError",
    "UnknownProductError",
    "UnsupportedSchemaVersionError",
]
