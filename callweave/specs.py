"""The three record types: schemas, accepted field names, keys and value rules.

Everything the transforms need to know about a record type is data in a
``RecordSpec``; the transforms themselves are the same for all three.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names and types of the three tables, in table order.
# ---------------------------------------------------------------------------
CDR_COLUMNS = (
    ("caller_id", "string"),
    ("callee_id", "string"),
    ("call_start", "timestamp"),
    ("call_duration", "int"),
    ("call_type", "string"),
    ("cell_id", "string"),
    ("location", "string"),
    ("imei", "string"),
    ("is_fraud", "boolean"),
)
IPDR_COLUMNS = (
    ("user_id", "string"),
    ("timestamp", "timestamp"),
    ("domain", "string"),
    ("ip_dst", "string"),
    ("port", "int"),
    ("protocol", "string"),
    ("duration", "int"),
    ("bytes_sent", "int"),
    ("bytes_received", "int"),
    ("vpn_usage", "boolean"),
    ("is_fraud", "boolean"),
)
EDR_COLUMNS = (
    ("event_id", "string"),
    ("user_id", "string"),
    ("device_model", "string"),
    ("os_type", "string"),
    ("roaming_status", "boolean"),
    ("network_type", "string"),
    ("event_time", "timestamp"),
    ("location", "string"),
    ("event_type", "string"),
    ("is_fraud", "boolean"),
)

# ---------------------------------------------------------------------------
# Accepted source names per column. `connection_time` of an
# internet session counts as its duration.
# ---------------------------------------------------------------------------
CDR_NAMES = {
    "caller_id": ("caller_id", "calling_party", "a_number", "originating_number"),
    "callee_id": ("callee_id", "called_party", "b_number", "terminating_number"),
    "call_start": ("call_start", "start_time", "setup_time", "connection_time"),
    "call_duration": ("call_duration", "duration", "call_length", "billable_seconds"),
    "call_type": ("call_type", "service_type", "call_category", "communication_type"),
    "cell_id": ("cell_id", "cell_identity", "tower_id", "bts_id"),
    "location": ("location", "geo_coordinates", "tower_location", "subscriber_location"),
    "imei": ("imei", "device_id", "terminal_id", "equipment_id"),
    "is_fraud": ("is_fraud",),
}
IPDR_NAMES = {
    "user_id": ("user_id", "subscriber_id", "customer_id", "msisdn"),
    "timestamp": ("timestamp", "access_time", "event_timestamp"),
    "domain": ("domain", "destination_domain", "host", "url"),
    "ip_dst": ("ip_dst", "destination_ip", "remote_ip", "server_ip"),
    "port": ("port", "dest_port", "server_port", "remote_port"),
    "protocol": ("protocol", "service_protocol", "conn_protocol", "transport_protocol"),
    "duration": ("duration", "session_duration", "time_spent", "connection_time"),
    "bytes_sent": ("bytes_sent", "upload_bytes", "upstream_data", "tx_bytes"),
    "bytes_received": ("bytes_received", "download_bytes", "downstream_data", "rx_bytes"),
    "vpn_usage": ("vpn_usage", "vpn_detected", "is_vpn", "encrypted_tunnel"),
    "is_fraud": ("is_fraud",),
}
EDR_NAMES = {
    "event_id": ("event_id", "session_id", "transaction_id", "tracking_id"),
    "user_id": ("user_id", "subscriber_id", "msisdn", "phone_number"),
    "device_model": ("device_model", "device_type", "handset", "terminal_model"),
    "os_type": ("os_type", "os_version", "platform", "device_os"),
    "roaming_status": ("roaming_status", "is_roaming", "roaming_active", "home_network"),
    "network_type": ("network_type", "connection_type", "access_technology", "bearer_type"),
    "event_time": ("event_time", "timestamp", "log_time", "recorded_at"),
    "location": ("location", "geo_coordinates", "position", "cell_location"),
    "event_type": ("event_type", "action", "event_name", "service_action"),
    "is_fraud": ("is_fraud",),
}
# Older names, understood only where a caller asks for them.
LEGACY_NAMES = {
    "cdr": {"call_duration": "duration"},
    "ipdr": {"bytes_sent": "bytes", "vpn_usage": "vpn"},
    "edr": {},
}

# ---------------------------------------------------------------------------
# Accepted category values, fallbacks and text defaults.
# ---------------------------------------------------------------------------
CALL_TYPES = ("voice_in", "voice_out", "sms_in", "sms_out")
PROTOCOLS = ("TCP", "UDP")
NETWORK_TYPES = ("4G", "5G", "3G", "WIFI", "LTE")
EVENT_TYPES = ("app_launch", "login", "logout", "payment", "SIM switch", "roaming event", "reboot")
PUBLISHED_EVENT_TYPES = ("app_launch", "login", "logout", "payment", "SIM switch", "roaming event")
ENUM_FALLBACK = {"call_type": "voice_in", "protocol": "tcp", "event_type": "app_launch", "network_type": "4g"}
TEXT_DEFAULTS = {
    "protocol": "TCP",
    "call_type": "voice_in",
    "event_type": "app_launch",
    "network_type": "4G",
    "os_type": "Android",
}
UNKNOWN = "unknown"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

_DDL = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class RecordSpec:
    """One record type. ``keys`` are also the columns a live row must carry."""

    name: str
    columns: tuple[tuple[str, str], ...]
    names: dict[str, tuple[str, ...]]
    keys: tuple[str, ...]
    event_time: str
    subscriber: str
    enums: dict[str, tuple[str, ...]]
    published_enums: dict[str, tuple[str, ...]]
    batch_enums: tuple[str, ...] = ()
    zero_filled: tuple[str, ...] = ()
    merged_files: tuple[str, ...] = ()

    @cached_property
    def fields(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    def of_type(self, ddl: str) -> tuple[str, ...]:
        return tuple(name for name, kind in self.columns if kind == ddl)

    def kind(self, field: str) -> str:
        return dict(self.columns)[field]

    def accepted(self, field: str, legacy: bool = False) -> tuple[str, ...]:
        """Source names that feed ``field``."""
        old = LEGACY_NAMES[self.name].get(field) if legacy else None
        known = self.names[field]
        return known + (old,) if old and old not in known else known

    def name_lookup(self, legacy: bool = False) -> dict[str, str]:
        """Source name -> column."""
        return {alias: field for field in self.fields for alias in self.accepted(field, legacy)}

    @property
    def table(self) -> str:
        return self.name

    @property
    def topic(self) -> str:
        return self.name

    @property
    def row_tag(self) -> str:
        return f"{self.name}_record"

    @cached_property
    def table_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _DDL[k]) for n, k in self.columns])

    @cached_property
    def message_schema(self) -> T.StructType:
        """As the table, but the event time is still text."""
        return T.StructType(
            [T.StructField(n, T.StringType() if k == "timestamp" else _DDL[k]) for n, k in self.columns]
        )

    @cached_property
    def standard_schema(self) -> T.StructType:
        """Rows after name mapping: flags are booleans, all else is text."""
        return T.StructType(
            [T.StructField(n, T.BooleanType() if k == "boolean" else T.StringType()) for n, k in self.columns]
        )


CDR = RecordSpec(
    name="cdr",
    columns=CDR_COLUMNS,
    names=CDR_NAMES,
    keys=("caller_id", "callee_id", "call_start"),
    event_time="call_start",
    subscriber="caller_id",
    enums={"call_type": CALL_TYPES},
    published_enums={"call_type": CALL_TYPES},
    batch_enums=("call_type",),
    merged_files=("final_cdr.csv",),
)
IPDR = RecordSpec(
    name="ipdr",
    columns=IPDR_COLUMNS,
    names=IPDR_NAMES,
    keys=("user_id", "timestamp", "domain"),
    event_time="timestamp",
    subscriber="user_id",
    enums={"protocol": PROTOCOLS},
    published_enums={"protocol": PROTOCOLS},
    zero_filled=("port", "duration", "bytes_sent", "bytes_received"),
    merged_files=("final_ipdr.csv",),
)
EDR = RecordSpec(
    name="edr",
    columns=EDR_COLUMNS,
    names=EDR_NAMES,
    keys=("event_id", "user_id", "event_time"),
    event_time="event_time",
    subscriber="user_id",
    enums={"event_type": EVENT_TYPES, "network_type": NETWORK_TYPES},
    published_enums={"event_type": PUBLISHED_EVENT_TYPES, "network_type": NETWORK_TYPES},
    merged_files=("final_edr.csv", "finaledr.csv"),
)
SPECS = {spec.name: spec for spec in (CDR, IPDR, EDR)}


def spec_for(record_type: str | RecordSpec) -> RecordSpec:
    """The spec of a type name; an unknown name is an error."""
    if isinstance(record_type, RecordSpec):
        return record_type
    if record_type not in SPECS:
        raise ValueError(f"unknown record type {record_type!r}; expected one of {sorted(SPECS)}")
    return SPECS[record_type]
