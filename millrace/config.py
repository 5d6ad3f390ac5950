"""Configuration: YAML or JSON, folders from the environment, and checks before a run."""

from __future__ import annotations

import hashlib
import json
import os
import re

#: Environment variables that replace folders of the configuration.
FOLDERS = {"DATA_DIR": "data_dir", "CACHE_DIR": "cache_dir", "CHECKPOINT_DIR": "checkpoint_dir", "LOG_DIR": "log_dir", "MANIFEST_DIR": "manifest_dir"}


def load(path: str, env: dict[str, str] | None = None) -> dict:
    """Read a configuration and put folders from the environment into its ``paths``."""
    env = os.environ if env is None else env
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        config = json.loads(text)
    else:
        import yaml

        config = yaml.safe_load(text)
    paths = config.setdefault("paths", {})
    for name, key in FOLDERS.items():
        if env.get(name):
            paths[key] = env[name]
    if env.get("CPT_RESUME"):
        config.setdefault("checkpointing", {})["resume_from"] = env["CPT_RESUME"]
    return config


def dump(config: dict, path: str) -> None:
    """Write a configuration as it is used, as YAML, or JSON by the name of the file."""
    with open(path, "w", encoding="utf-8") as f:
        if path.endswith(".json"):
            json.dump(config, f, ensure_ascii=False, indent=2)
        else:
            import yaml

            yaml.safe_dump(config, f, allow_unicode=True, sort_keys=False)


def only(catalog: dict[str, dict], source: str | None) -> dict[str, dict]:
    """The catalog, or its one entry of a name; an unknown one is an error."""
    if source is None:
        return catalog
    if source not in catalog:
        raise ValueError(f"unknown source {source}")
    return {source: catalog[source]}


def frozen(config: dict, revisions: dict[str, str]) -> dict:
    """The configuration with the revision of each mirror (labels, and secondary sources by name), as given by its folder's record; each must be a commit."""
    out = json.loads(json.dumps(config))
    for name, revision in revisions.items():
        if not REVISION.fullmatch(revision or ""):
            raise ValueError(f"{name} has no pinned revision")
        if name == "labels":
            out["labels_revision"] = revision
        else:
            for entry in out.get("secondary", []):
                if entry["name"] == name:
                    entry["revision"] = revision
    return out


def mirror_revision(folder: str) -> str:
    """The revision that a local mirror records in its file ``REVISION``."""
    with open(os.path.join(folder, "REVISION"), encoding="utf-8") as f:
        return f.read().strip()


def require_same_signature(stored: dict, given: dict) -> None:
    """A run goes on only with the data and settings it began with."""
    for part in ("data", "training"):
        if stored.get(part) != given.get(part):
            raise ValueError(f"the {part} signature differs from that of the checkpoint")


def phase(config: dict, number: int) -> dict:
    for p in config.get("phases", []):
        if int(p["id"]) == number:
            return p
    raise ValueError(f"no phase {number}")


def cache_name(number: int, split: str = "train") -> str:
    return f"phase_{number}" + ("" if split == "train" else f"_{split}")


def fingerprint(*parts: object) -> str:
    """SHA-256 of the parts as JSON with sorted keys."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


REVISION = re.compile(r"[0-9a-f]{40}")


def require_runnable(config: dict, root: str) -> None:
    """Exactly one phase, an absolute existing root, every folder below it, a token budget above 0, and pinned revisions of the labels and of the secondary sources."""
    if len(config.get("phases", [])) != 1:
        raise ValueError("one phase is needed")
    if not os.path.isabs(root) or not os.path.isdir(root):
        raise ValueError("the storage root must be an existing absolute folder")
    for key, folder in config.get("paths", {}).items():
        if os.path.commonpath([os.path.realpath(root), os.path.realpath(folder)]) != os.path.realpath(root):
            raise ValueError(f"{key} lies outside the storage root")
    if not config["phases"][0].get("max_tokens", 0) > 0:
        raise ValueError("a token budget above 0 is needed")
    wanted = {"labels": config.get("labels_revision"), **{s["name"]: s.get("revision") for s in config.get("secondary", [])}}
    for name, revision in wanted.items():
        if not REVISION.fullmatch(revision or ""):
            raise ValueError(f"{name} has no pinned revision; freeze the inputs first")
