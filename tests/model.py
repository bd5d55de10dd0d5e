"""A plain-Python model of the reference job's behaviour, file by file, used
to check the set-based ``apply_run``.  Written from the documented rules:
reconcile missing names first, then walk the listing in key order, skip live
(name, hash), remove the first live version with the same hash under another
name, dedup, convert, record, upsert where the cost is strictly higher."""
from __future__ import annotations

import hashlib


def vid(run_id, name, h):
    return hashlib.sha256("~".join([run_id, name, h]).encode()).hexdigest()


def model_run(registry, target, listing, contents, rates, run_id):
    """registry: list of dicts (file_name, file_hash, file_version_id, status);
    target: dict key -> dict(cost, cost_usd, file_name, file_version_id);
    listing: list of (object_key, file_name, file_hash);
    contents: hash -> list of (key, cost) or None (rejected file);
    rates: currency -> rate.  Mutates and returns (registry, target)."""
    def kill(version):
        for k in [k for k, v in target.items() if v["file_version_id"] == version]:
            del target[k]
        for r in registry:
            if r["file_version_id"] == version and r["status"] == "processed":
                r["status"], r["file_hash"] = "deleted", None

    last = {}
    for r in registry:  # registry order = processing order; the last one wins
        if r["status"] == "processed":
            last[r["file_name"]] = r["file_version_id"]
    listed = {name for _, name, _ in listing}
    for name, version in last.items():
        if name not in listed:
            kill(version)

    for key, name, h in sorted(listing):
        if not name.endswith(".parquet"):
            continue
        if any(r["file_name"] == name and r["file_hash"] == h and r["status"] == "processed"
               for r in registry):
            continue
        others = sorted((r["file_name"], r["file_version_id"]) for r in registry
                        if r["file_hash"] == h and r["file_name"] != name
                        and r["status"] == "processed")
        if others:
            kill(others[0][1])
        rows = contents[h]
        if rows is None:
            continue
        best = {}
        for k, cost in rows:
            if k not in best or cost > best[k]:
                best[k] = cost
        version = vid(run_id, key, h)
        registry.append({"file_name": name, "file_hash": h, "file_version_id": version,
                         "status": "processed"})
        for k, cost in best.items():
            rate = rates.get(k[2])
            if rate is None:
                continue
            row = {"cost": cost, "cost_usd": cost * rate, "file_name": name,
                   "file_version_id": version}
            if k not in target or target[k]["cost"] < cost:
                target[k] = row
    return registry, target
