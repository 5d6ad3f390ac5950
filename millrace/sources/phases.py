"""Folders and records of phases on a file system that the driver sees: dealt files, checkpoints, downloads."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Sequence

from millrace.operators.partition import Shard, largest_first


def put_json(path: str, value: dict) -> None:
    """Write beside the place, then rename."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
    os.replace(path + ".tmp", path)


def deal_files(shards: Sequence[Shard], out: str, phases: int, copy: bool = False, dry_run: bool = False) -> list[dict]:
    """Deal files (absolute paths) by size into ``phase_1``.. below ``out`` as links or copies, each with a manifest; returns the manifests.

    Names that repeat are made distinct by their folder. A dry run writes nothing.
    """
    groups = largest_first(shards, phases)
    whole = sum(n for _, n in shards)
    manifests = []
    for i, files in enumerate(groups, 1):
        size = sum(n for _, n in files)
        manifests.append({"phase": i, "files": [p for p, _ in files], "bytes": size, "percent": round(100 * size / whole, 2) if whole else 0.0})
        if dry_run:
            continue
        folder = os.path.join(out, f"phase_{i}")
        os.makedirs(folder, exist_ok=True)
        for source, _ in files:
            name = os.path.join(folder, f"{os.path.basename(os.path.dirname(source))}__{os.path.basename(source)}")
            if os.path.lexists(name):
                os.remove(name)
            (shutil.copy2 if copy else os.symlink)(source, name)
        put_json(os.path.join(out, f"phase_{i}.json"), manifests[-1])
    if not dry_run:
        put_json(os.path.join(out, "phases.json"), {"phases": manifests, "total_bytes": whole, "total_files": len(shards)})
    return manifests


def newest_checkpoint(root: str, marker: str = "training_state.pt") -> str | None:
    """The checkpoint that ``latest.json`` names, if it is whole; else the newest folder that is."""
    try:
        with open(os.path.join(root, "latest.json"), encoding="utf-8") as f:
            named = os.path.join(root, json.load(f)["path"])
        if os.path.exists(os.path.join(named, marker)):
            return named
    except (OSError, ValueError, KeyError):
        pass
    whole = [e.path for e in os.scandir(root) if e.is_dir() and os.path.exists(os.path.join(e.path, marker))] if os.path.isdir(root) else []
    return max(whole, key=os.path.getmtime) if whole else None


def record_checkpoint(root: str, folder: str, **more) -> None:
    """Name the newest checkpoint in ``latest.json``, in one step."""
    put_json(os.path.join(root, "latest.json"), {"path": os.path.relpath(folder, root), **more})


def expired_checkpoints(folders: Sequence[str], keep: int) -> list[str]:
    """All but the last ``keep``, in the order given; none if ``keep`` is 0."""
    return list(folders[:-keep]) if keep > 0 else []


def download_done(written: int, target_gb: float, enough: float = 0.95) -> bool:
    """A download counts as complete from 95 % of its target on."""
    return written >= enough * target_gb * 1024**3
