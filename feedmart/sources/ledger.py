"""Commit log of a store.

Everything that decides what a reader of the store sees is an entry of this log: which run of a load holds its raw rows, which version of
the mart is current, how many buckets the core tables have, which steps of a load are done. An entry is one small JSON file with
a number in its name, created only if no file has that name, so a change is there as a whole or not at all, and two writers that
took the same number can't both succeed. The state is the fold of all entries. Every SNAPSHOT_EVERY entries the folded state is
written beside them and older entries are removed, so the log's folder stays short.

Events of a load: ``begin`` (an intent: run, name, parameters), ``raw`` (its raw rows are complete), ``step`` (one table is written),
``log`` (the day counts of what it added are written), ``end`` or ``abort``. A load that has begun and neither ended nor been aborted
is open; ``plans.load.repair`` replays it.
"""

from __future__ import annotations

import copy
import json
import threading

from pyspark.sql import SparkSession

from feedmart.session import child_names, create_file, delete_path, read_files

SNAPSHOT_EVERY = 100


def empty_state() -> dict:
    return {"seq": 0, "last_load": 0, "last_new_id": 0, "names": {}, "loads": {}, "tables": {}, "logs": {}}


def _load_event(load: dict, entry: dict) -> None:
    event = entry["event"]
    if event == "begin":
        load |= {"open": entry["run"], "runs": load["runs"] + 1, "done": [], "written": False, "intent": entry["compat"]}
    elif event == "raw":
        load["replaced"] += [load["raw"]] if load["raw"] is not None else []
        load |= {"raw": entry["run"], "sources": entry["sources"], "written": True, "compat": load["intent"]}
    elif event == "step":
        load["done"].append(entry["step"])
    elif event == "log":
        load["logged"].setdefault(entry["table"], []).append(entry["run"])
        load["done"].append(entry["table"])
    elif event == "end":
        load |= {"open": None, "pairs": load["pairs"] or not load["compat"], "refused": load["refused"] or entry["refused"], "last_new_id": entry["last_new_id"]}
    elif event == "pairs":  # the bridge of a load that had none is filled in
        load["pairs"] = True
    elif event == "abort":
        load["open"] = None


def apply(state: dict, entry: dict) -> dict:
    """``state`` with one entry more (changed in place)."""
    event = entry["event"]
    state["seq"] = entry["seq"]
    if "load" in entry:
        fresh = {"raw": None, "sources": {}, "open": None, "runs": 0, "done": [], "written": False, "compat": True,
                 "replaced": [], "logged": {}, "pairs": False, "refused": False}
        _load_event(state["loads"].setdefault(str(entry["load"]), fresh), entry)
        state["last_load"] = max(state["last_load"], entry["load"])
        state["last_new_id"] = max(state["last_new_id"], entry.get("last_new_id", 0))
        if event == "begin" and entry["name"] is not None:
            state["names"][entry["name"]] = entry["load"]
        if event == "log":
            state["logs"].setdefault(entry["table"], []).append(entry["run"])
    elif event == "collected":  # the files of replaced runs are gone
        for load in state["loads"].values():
            load["replaced"] = [r for r in load["replaced"] if r not in entry["runs"]]
    else:  # "table": what belongs to a table as a whole (its current version, bucket count ...)
        state["tables"][entry["table"]] = {k: v for k, v in entry.items() if k not in ("seq", "event", "table")}
        if "merged" in entry:  # the log's runs up to this one are in its merged table
            state["logs"][entry["table"]] = [r for r in state["logs"].get(entry["table"], []) if r > entry["merged"]]
    return state


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._state = empty_state()
        self._lock = threading.RLock()
        self._alone = False  # between a load's begin and end nobody else writes

    def state(self) -> dict:
        """The folded state as of now. (Treat it as read-only.)"""
        with self._lock:
            return self._state if self._alone else self._folded()

    def _folded(self) -> dict:
        names = [n for n in child_names(self.spark, self.path) if n.endswith(".json")]
        shots = [n for n in names if n.endswith(".state.json") and int(n[:12]) > self._state["seq"]]
        if shots:
            self._state = json.loads(read_files(self.spark, [f"{self.path}/{shots[-1]}"])[0])
        fresh = [n for n in names if not n.endswith(".state.json") and int(n[:12]) > self._state["seq"]]
        state = copy.deepcopy(self._state) if fresh else self._state
        for text in read_files(self.spark, [f"{self.path}/{n}" for n in fresh]):
            apply(state, json.loads(text))
        self._state = state
        return state

    def note(self, event: str, at: int | None = None, **fields) -> int:
        """Add an entry; returns its number. With ``at`` it must become that number: it fails if another writer added one meanwhile."""
        with self._lock:
            return self._add(event, at, fields)

    def _add(self, event: str, at: int | None, fields: dict) -> int:
        seq = at or self.state()["seq"] + 1
        entry = {"seq": seq, "event": event} | fields
        create_file(self.spark, f"{self.path}/{seq:012d}.json", json.dumps(entry))
        state = self._state = apply(copy.deepcopy(self._state), entry)
        self._alone = event == "begin" or self._alone and event not in ("end", "abort")
        if seq % SNAPSHOT_EVERY == 0:
            create_file(self.spark, f"{self.path}/{seq:012d}.state.json", json.dumps(state))
            for name in child_names(self.spark, self.path):
                if name.endswith(".json") and int(name[:12]) <= seq - SNAPSHOT_EVERY:
                    delete_path(self.spark, f"{self.path}/{name}")
        return seq


__all__ = ["Ledger", "apply", "empty_state"]
