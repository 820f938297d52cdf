"""Exceptions raised by the library."""


class TransferError(Exception):
    """A transfer, replication or step could not be run as configured."""


class ConnectionFailed(TransferError):
    """A connection is unknown or a query on it failed."""


class UnsupportedError(TransferError):
    """The request is valid configuration, but has no Spark form in this library."""


class CheckFailed(TransferError):
    """A data check did not hold and its step does not tolerate failure."""
