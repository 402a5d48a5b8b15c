from blockmill.sources.manifest import append_manifest, audit_manifest, missing_shards, scan_manifest
from blockmill.sources.published import (
    audit_published, commit, publish_shards, published_manifest, scan_published, sweep, write_attempt,
)
from blockmill.sources.shards import (
    scan_packed, scan_shard_bytes, shard_files, shard_summary, stream_packed, write_shards,
)
from blockmill.sources.specs import source_specs, spec_list, validate_specs
from blockmill.sources.state import fingerprint, load_state, save_state
from blockmill.sources.text import scan_sources, scan_text, union_sources

__all__ = [
    "append_manifest", "audit_manifest", "audit_published", "commit", "fingerprint", "load_state",
    "missing_shards", "publish_shards", "published_manifest", "save_state", "scan_manifest", "scan_packed", "scan_shard_bytes", "scan_sources",
    "scan_text", "shard_files", "shard_summary", "source_specs", "spec_list",
    "scan_published", "stream_packed", "sweep", "union_sources", "validate_specs", "write_attempt",
    "write_shards",
]
