"""Extract-load and table processing on Spark."""

from .config import ReplicationStream, Source, SourceOptions, Target, TargetOptions
from .enums import Compression, Format, MergeStrategy, Mode
from .errors import CheckFailed, ConnectionFailed, TransferError, UnsupportedError
from .plans.apispec import ApiSpec
from .plans.modes import LoadReport, LoadSpec, load
from .plans.replication import Pipeline, Replication
from .plans.steps import (
    HookMap, StepCheck, StepCommand, StepCopy, StepDelete, StepGroup, StepHTTP, StepInspect,
    StepList, StepLog, StepQuery, StepRead, StepReplication, StepStore, StepWrite)
from .plans.targets import CatalogTable, FileTarget, JdbcTable, VersionedDataset
from .plans.transfer import Transfer
from .sources.connections import Connection, register

__all__ = [
    "ApiSpec", "CatalogTable", "CheckFailed", "Compression", "Connection", "ConnectionFailed",
    "FileTarget", "Format", "HookMap", "JdbcTable", "LoadReport", "LoadSpec", "MergeStrategy",
    "Mode", "Pipeline", "Replication", "ReplicationStream", "Source", "SourceOptions",
    "StepCheck", "StepCommand", "StepCopy", "StepDelete", "StepGroup", "StepHTTP", "StepInspect",
    "StepList", "StepLog", "StepQuery", "StepRead", "StepReplication", "StepStore", "StepWrite",
    "Target", "TargetOptions", "Transfer", "TransferError", "UnsupportedError",
    "VersionedDataset", "load", "register",
]
