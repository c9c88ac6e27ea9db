"""A plain sequential model of queue and index, against which the Spark jobs are tested."""

from __future__ import annotations

import datetime as dt
import heapq
import random

from shelfmark.config import DEFAULT_RULES

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def random_messages(scenarios, seed, length=14, span=16, dsids=("A", "B", "C", "")):
    """Messages of many independent scenarios (one object each), ordered by arrival."""
    rng = random.Random(seed)
    methods = sorted({r.method for r in DEFAULT_RULES}) + ["getObjectXML", "ingest", "addDatastream", "purgeObject"]
    rows = []
    for s in range(scenarios):
        for _ in range(rng.randint(1, length)):
            rows.append((rng.randint(0, span) + rng.choice([0, 0, 0.5]), s, rng.choice(methods), rng.choice(dsids)))
    rows.sort(key=lambda r: r[0])
    return [(i, f"p:{s}", m, d, at(t)) for i, (t, s, m, d) in enumerate(rows)]


def jobs_of(messages, rules=DEFAULT_RULES):
    jobs = []
    for msg_id, pid, method, dsid, arrival in messages:
        for idx, r in enumerate([r for r in rules if r.method == method]):
            own = dsid if r.keep_dsid else ""
            jobs.append(make_job(r.kind, r.op, pid, own, arrival, r.delay_s, (0, 0, "", msg_id, idx)))
    return jobs


def make_job(kind, op, pid, dsid, arrival, delay_s, seq):
    seq = (0, 0, "", seq, 0) if isinstance(seq, int) else tuple(seq)
    doc = pid if kind == "object" or dsid == "" else f"{pid}:{dsid}"
    return {
        "kind": kind, "op": op, "pid": pid, "dsid": dsid, "doc_id": doc, "arrival": arrival, "delay_s": delay_s,
        "ready_at": arrival + dt.timedelta(seconds=delay_s), "seq": seq,
    }


class Index:
    """Queue and index state; ``good_objects`` and ``good_datastreams`` are what can be built, ``listing`` what objects list."""

    def __init__(self, mode, good_objects=(), good_datastreams=(), listing=None, objects=None, datastreams=None, errors=None):
        self.mode, self.good_objects, self.good_datastreams = mode, set(good_objects), set(good_datastreams)
        self.listing = listing or {}
        self.objects, self.datastreams, self.errors = dict(objects or {}), dict(datastreams or {}), dict(errors or {})
        self.pending, self.released = {}, []

    def key(self, job):
        if self.mode == "corrected":
            return job["kind"], job["op"], job["doc_id"]
        return job["op"], job["pid"], job["dsid"]

    def run(self, jobs):
        events = [(j["arrival"], j["seq"], 0, i, j) for i, j in enumerate(jobs)]
        heapq.heapify(events)
        n = len(jobs)
        while events:
            _, seq, released, i, job = heapq.heappop(events)
            if not released:
                self.pending[self.key(job)] = job
                heapq.heappush(events, (job["ready_at"], seq, 1, i, job))
            elif self.pending.get(self.key(job)) is job:
                del self.pending[self.key(job)]
                self.released.append(job)
                for new in self.perform(job):
                    n += 1
                    heapq.heappush(events, (new["arrival"], new["seq"], 0, n, new))
        return self

    def perform(self, job):
        pid, doc, op, kind = job["pid"], job["doc_id"], job["op"], job["kind"]
        if op == "DELETE":
            if kind == "object":
                self.objects.pop(pid, None)
                self.datastreams = {d: v for d, v in self.datastreams.items() if v[0] != pid}
                self.errors = {d: e for d, e in self.errors.items() if e[0] != pid}
                gone = [k for k, j in self.pending.items() if j["pid"] == pid]
            else:
                self.errors.pop(doc, None)
                if self.mode == "corrected":
                    self.datastreams.pop(doc, None)
                gone = [k for k, j in self.pending.items() if j["kind"] != "object" and j["doc_id"] == doc]
            if self.mode == "corrected":
                for k in gone:
                    del self.pending[k]
            return []
        good = pid in self.good_objects if kind == "object" else doc in self.good_datastreams
        if not good:
            self.errors[doc] = (pid, job["dsid"], f"[{op}] [{doc}]", job["ready_at"])
            return []
        if kind == "object":
            self.objects[pid] = self.objects.get(pid, 0) + 1
            self.errors.pop(doc, None)
            if op == "CREATE":
                return [
                    make_job("datastream", "CREATE", pid, d, job["ready_at"], 0, (job["seq"][0] + 1, *job["seq"][1:]))
                    for d in self.listing.get(pid, ())
                ]
            return []
        created = doc not in self.datastreams
        self.datastreams[doc] = (pid, self.datastreams.get(doc, (pid, 0))[1] + 1)
        if created or self.mode == "corrected":
            self.errors.pop(doc, None)
        return []
