"""Typed failures, so callers can tell a wrong lake from a wrong argument."""


class LakeError(Exception):
    """Any problem with what a lake holds, as opposed to how it was asked."""


class CatalogNotFoundError(LakeError):
    """There is no catalog under the root."""


class IncompatibleContractError(LakeError):
    """The catalog follows a contract line this package does not read."""


class UnknownProductError(LakeError):
    """The catalog does not list the product."""


class UnsupportedSchemaVersionError(LakeError):
    """The product, or a row, is at a schema version this package does not read."""


class BatchMixUpError(LakeError):
    """A batch of this name is logged already, with other responses."""


class MissingBodyError(LakeError):
    """A poll has to be published now, but its response is nowhere to be read again."""


class QuarantinedError(LakeError):
    """Responses of a run were not as declared; the others are published. ``batches`` names the
    quarantine's batches that hold them."""

    def __init__(self, message: str, batches: tuple[str, ...] = ()) -> None:
        super().__init__(message)
        self.batches = batches


class BusyError(LakeError):
    """Other writers kept changing a document while it was to be published."""
