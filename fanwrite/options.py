"""Job options for the fan-out jobs (stream and bulk)."""

from __future__ import annotations

from dataclasses import dataclass, field

# The option flags a fan-out job accepts on its command line,
# the default micro-batch interval in seconds, the enrichment field and its
# value, the column family, the blob qualifier, the separator between base
# table and tenant, the event-time text format and the re-stamp offset in
# minutes.
FLAG_TABLE_SINK = "-sendToHbase"
FLAG_INDEX_SINK = "-sendToES"
FLAG_PARALLEL = "-parallel"
FLAG_SINGLE_TABLE = "-singleTable"
FLAG_SINGLE_COLUMN = "-singleColumn"
FLAG_DURATION = "-duration="
DEFAULT_DURATION_SECONDS = 10
ENRICH_FIELD = "obscountry"
ENRICH_VALUE = "US"
FAMILY = "evt"
BLOB_QUALIFIER = "data"
TABLE_SEPARATOR = "-"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
RESTAMP_OFFSET_MINUTES = 330

# Event field codes with a meaning in the engine.
ID_FIELD = "id"
TENANT_FIELD = "rv39"

LAYOUTS = ("blob", "wide")
ROW_KEYS = ("id", "position", "blob", "auto", "random")


@dataclass(frozen=True)
class FanoutOptions:
    """Everything a fan-out run needs besides its source and output roots.

    ``layout``: ``"blob"`` writes one ``evt:data`` cell holding ``{k=v, ...}``;
    ``"wide"`` writes one cell per field.  ``single_table`` routes everything to
    ``base_table``; otherwise each tenant gets ``<base_table>-<tenant>`` and
    events without a tenant go to ``unrouted_table``.
    """

    send_to_table: bool = False
    send_to_index: bool = False
    parallel: bool = False
    single_table: bool = False
    layout: str = "blob"
    duration_seconds: int = DEFAULT_DURATION_SECONDS
    base_table: str = "events"
    unrouted_table: str = "unrouted"
    family: str = FAMILY
    row_key: str = "auto"
    index_id_field: str = ID_FIELD
    tenant_field: str = TENANT_FIELD
    enrich: dict = field(default_factory=lambda: {ENRICH_FIELD: ENRICH_VALUE})
    on_bad: str = "reject"          # "reject" rows failing decode, or "fail" the batch
    index_errors: str = "raise"     # "raise" fails the batch; "log" prints and goes on
    file_layout: str = "auto"  # "rebalance", "narrow", or "auto" (narrow for one table)
    max_records_per_file: int | None = None

    def __post_init__(self):
        if self.layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}, got {self.layout!r}")
        if self.row_key not in ROW_KEYS:
            raise ValueError(f"row_key must be one of {ROW_KEYS}, got {self.row_key!r}")
        if self.on_bad not in ("reject", "fail"):
            raise ValueError("on_bad must be 'reject' or 'fail'")
        if self.index_errors not in ("raise", "log"):
            raise ValueError("index_errors must be 'raise' or 'log'")
        if self.file_layout not in ("auto", "rebalance", "narrow"):
            raise ValueError("file_layout must be 'auto', 'rebalance' or 'narrow'")
        if self.duration_seconds <= 0:
            raise ValueError("duration_seconds must be positive")

    @property
    def rebalance_writes(self) -> bool:
        """Shuffle cells by table before writing?  With one table every input
        task writes one file anyway, so ``auto`` skips the shuffle there."""
        if self.file_layout == "auto":
            return not self.single_table
        return self.file_layout == "rebalance"

    @property
    def trigger_interval(self) -> str:
        return f"{self.duration_seconds} seconds"

    @classmethod
    def from_flags(cls, args: list[str] | None, **defaults) -> "FanoutOptions":
        """Options from command-line style flags; an unknown flag raises."""
        values = dict(defaults)
        for arg in args or []:
            if arg == FLAG_TABLE_SINK:
                values["send_to_table"] = True
            elif arg == FLAG_INDEX_SINK:
                values["send_to_index"] = True
            elif arg == FLAG_PARALLEL:
                values["parallel"] = True
            elif arg == FLAG_SINGLE_TABLE:
                values["single_table"] = True
            elif arg == FLAG_SINGLE_COLUMN:
                values["layout"] = "blob"
            elif arg.startswith(FLAG_DURATION):
                values["duration_seconds"] = int(arg[len(FLAG_DURATION):])
            else:
                raise ValueError(f"unsupported argument {arg!r}")
        return cls(**values)
