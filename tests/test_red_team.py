"""Export folders broken on purpose: each is read whole and must raise exactly the codes of what was broken."""

from __future__ import annotations

import copy
import csv
import gzip
import hashlib
import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pytest

from tallyloom.functions.labels import TOPICS
from tallyloom.operators import audit, corpus
from tallyloom.session import shared_dir
from tallyloom.sources.exports import SHEETS, read_export

COPIES = {"r07": "r01", "r10": "r02", "r14": "r04"}
TEXTS = {
    "r01": "Too many ads", "r02": "It crashes each time", "r03": "Ads again and again", "r04": "Love it", "r05": "", "r06": "Lost my lists", "r08": "  Fine   player  ", "r09": " \t\n", "r11": "Please add a timer", "r12": "Shuffle is broken", "r13": "Great",
}
TEXTS |= {c: TEXTS[o] for c, o in COPIES.items()}
INTENT = dict.fromkeys(("r01", "r02", "r03", "r06", "r12"), "complaint") | {"r11": "request"}
SEVERITY = {"r01": 3, "r02": 5, "r03": 2, "r06": 4, "r12": 2}
FIRST, RESUMED = ["r01", "r02", "r03", "r04"], ["r06", "r08", "r11", "r12", "r13"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def call(name: str, ids: list[str] | None, phase: str | None = "initial", role: str = "enrich", config: str = "LC1", outcome: str = "succeeded", **more: object) -> dict:
    return {"request_id": name, "role": role, "review_ids": ids, "phase": phase, "outcome": outcome, "label_config": config, "input_tokens": 100, "output_tokens": 50} | more


def record(key: str) -> dict:
    if not TEXTS[key].strip():
        return {"review_id": key, "source_sha256": sha(TEXTS[key]), "status": "quarantined", "reason": "empty text"}
    own = COPIES.get(key, key)
    out = {"review_id": key, "source_sha256": sha(TEXTS[key]), "status": "completed", "topic": TOPICS[0 if own in ("r01", "r03") else 1], "intent": INTENT.get(own, "praise"), "severity": SEVERITY.get(own, 1), "sentiment": 0.25, "evidence_quote": TEXTS[key].strip(), "label_config": "LC1"}
    return out | ({"cache_source_id": own} if key in COPIES else {})


def base() -> dict:
    """A folder that is right: two initial and two resumed calls, a ranking of two issues."""
    records = {k: record(k) for k in sorted(TEXTS)}
    done = [k for k, r in records.items() if r["status"] == "completed"]
    ranked = [(f"IS-{r['topic']}", k, r["severity"]) for k, r in records.items() if r.get("intent") == "complaint"]
    sums = {i: [s for j, _, s in ranked if i == j] for i in {i for i, _, _ in ranked}}
    order = sorted(sums, key=lambda i: (-sum(sums[i]), i))
    ranking = [[str(n + 1), i, str(len(sums[i])), str(sum(sums[i])), f"{round(sum(sums[i]) / len(sums[i]) + 1e-12, 6):.6f}", str(sum(sums[i]))] for n, i in enumerate(order)]
    claims = [[f"CL-{4 * n + m + 1:03d}", row[1], metric, row[m + 2]] for n, row in enumerate(ranking) for m, metric in enumerate(SHEETS["ranking.csv"][2:])]
    calls = [call("e1", ["r01", "r02"]), call("e2", ["r03", "r04"]), call("e3", ["r06", "r08", "r11"], "resume"), call("e4", ["r12", "r13"], "resume")]
    calls += [call(role, [], None, role) for role in ("verify", "group", "memo")]
    return {"records": records, "calls": calls, "membership": [[i, k] for i, k, _ in ranked], "ranking": ranking, "claims": claims, "before": list(FIRST), "after": done, "raw": {}}


def put(state: dict, folder) -> None:
    lines = {"records.jsonl": state["records"].values(), "calls.jsonl": state["calls"], "checkpoint_before.json": [{"review_id": k} for k in state["before"]], "checkpoint_after.json": [{"review_id": k} for k in state["after"]]}
    for name, rows in lines.items():
        (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    for name, fields in SHEETS.items():
        with (folder / name).open("w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([fields, *state[name.split(".")[0]]])
    for name, raw in state["raw"].items():
        (folder / name).unlink(missing_ok=True)
        if raw is not None:
            (folder / name).write_bytes(raw)


def set_record(key: str, **fields: object) -> Callable[[dict], None]:
    return lambda s: s["records"][key].update(fields)


def add(*calls: dict, first: bool = False) -> Callable[[dict], None]:
    return lambda s: s["calls"].__setitem__(slice(0, 0) if first else slice(len(s["calls"]), None), copy.deepcopy(calls))


def edit(name: str, **fields: object) -> Callable[[dict], None]:
    return lambda s: next(c for c in s["calls"] if c["request_id"] == name).update(fields)


def drop_field(name: str, *fields: str) -> Callable[[dict], None]:
    return lambda s: [next(c for c in s["calls"] if c["request_id"] == name).pop(f) for f in fields] and None


def listed(name: str, *keys: str) -> Callable[[dict], None]:
    return lambda s: s[name].extend(keys)


def raw(name: str, data: bytes | None) -> Callable[[dict], None]:
    return lambda s: s["raw"].__setitem__(name, data)


def many(*steps: Callable[[dict], None]) -> Callable[[dict], None]:
    return lambda s: [f(s) for f in steps] and None


def moved_copy(s: dict) -> None:
    """The original of the first text is its later copy, which a resumed call labelled."""
    s["records"]["r01"]["cache_source_id"] = s["records"]["r07"].pop("cache_source_id") and "r07"
    edit("e1", review_ids=["r02"])(s)
    edit("e4", review_ids=["r12", "r13", "r07"])(s)


LOST = {"claim_mismatch", "invalid_membership", "ranking_mismatch", "resume_call_evidence", "resume_snapshot_mismatch", "unfinished_classification", "unsupported_quote"}
BROKEN_REUSE = {"invalid_cache_reuse", "resume_snapshot_mismatch", "unfinished_classification"}
CASES: dict[str, tuple[Callable[[dict], None], set[str]]] = {
    "clean": (lambda s: None, set()),
    # one record in several calls
    "two initial calls": (add(call("x", ["r01"])), set()),
    "a resumed call for a finished record": (add(call("x", ["r01"], "resume")), {"reprocessed_checkpoint"}),
    "two configs, both initial": (many(set_record("r01", label_config="LC2"), set_record("r07", label_config="LC2"), add(call("x", ["r01"], config="LC2"))), {"call_config_mismatch"}),
    "two configs, the second after the checkpoint": (many(set_record("r03", label_config="LC2"), add(call("x", ["r03"], "resume", config="LC2"))), {"call_config_mismatch", "reprocessed_checkpoint", "resume_call_evidence"}),
    "the first config's call failed": (many(set_record("r12", label_config="LC2"), set_record("r13", label_config="LC2"), edit("e4", outcome="failed"), add(call("x", ["r12", "r13"], "resume", config="LC2"))), set()),
    "development calls, same config": (add(call("x", ["r01", "r04", "r12"])), set()),
    "development calls, other config": (add(call("x", ["r01", "r12"], config="dev")), {"call_config_mismatch"}),
    "a phase that is none": (add(call("x", ["r12"], "dev")), {"invalid_run_phase"}),
    "a failed call without a phase": (lambda s: s["calls"].append({k: v for k, v in call("x", ["r12"], outcome="failed").items() if k != "phase"}), {"invalid_run_phase"}),
    "a checkpoint's call marked resumed": (edit("e1", phase="resume"), {"reprocessed_checkpoint", "resume_call_evidence"}),
    # copies
    "the original is not the first": (many(moved_copy, lambda s: s["before"].remove("r01")), set()),
    "a copy finished before its original": (moved_copy, set()),
    "a chain of copies": (set_record("r14", cache_source_id="r10"), BROKEN_REUSE),
    "a copy of an original without a call": (edit("e1", review_ids=["r01"]), {"unlogged_completed_records", "resume_call_evidence"}),
    "only copies finished after the resume": (many(edit("e3", phase="initial"), edit("e4", phase="initial"), lambda s: s.update(before=[*FIRST, *RESUMED])), {"resume_call_evidence"}),
    # calls of other roles, usage, ids
    "a check of records under another config": (edit("verify", review_ids=["r01", "r12"], label_config="v2"), set()),
    "other roles without tokens": (many(edit("memo", input_tokens=0, output_tokens=0), edit("group", input_tokens=0, output_tokens=0)), set()),
    "tokens missing": (drop_field("e2", "input_tokens", "output_tokens"), {"invalid_usage"}),
    "one null of a memo": (edit("memo", output_tokens=None), {"invalid_usage"}),
    "tokens with a fraction": (edit("e2", input_tokens=1000.0), {"invalid_usage"}),
    "a request without id": (edit("verify", request_id=None), {"invalid_request_id"}),
    "a retry under the same id": (add(call("e4", ["r12"], "resume", outcome="failed")), {"invalid_request_id"}),
    "a call with an unknown record": (edit("e4", review_ids=["r12", "r13", "r99"]), {"invalid_call_ids", "unlogged_completed_records"}),
    "a call that does not say what it covers": (drop_field("memo", "review_ids"), {"invalid_call_ids", "missing_model_roles"}),
    "no memo was written": (lambda s: s["calls"].pop(), {"missing_model_roles"}),
    # records
    "a text given up, still listed as finished": (lambda s: s["records"].__setitem__("r13", {"review_id": "r13", "source_sha256": sha(TEXTS["r13"]), "status": "quarantined", "reason": "no answer"}), {"unfinished_classification", "resume_snapshot_mismatch"}),
    "empty texts listed as finished": (many(listed("before", "r05"), listed("after", "r05")), {"resume_call_evidence", "resume_snapshot_mismatch"}),
    "another reason for white space": (set_record("r09", reason="white"), {"incorrect_empty_reason"}),
    "a tone that is true": (set_record("r13", sentiment=True), {"invalid_schema", "resume_snapshot_mismatch", "unfinished_classification"}),
    "a quote in other letters, ranked and finished before": (set_record("r03", evidence_quote="ADS AGAIN"), LOST),
    "a record twice": (raw("records.jsonl", "".join(json.dumps(record(k)) + "\n" for k in [*sorted(TEXTS), "r13"]).encode()), {"duplicate_review_id", "resume_snapshot_mismatch", "unfinished_classification"}),
    "a record of no source": (lambda s: s["records"].__setitem__("r77", record("r13") | {"review_id": "r77"}), {"unknown_review_id"}),
    # tables and snapshots
    "nothing was finished before": (lambda s: s.update(before=[]), {"resume_snapshot_mismatch"}),
    "nothing was added": (lambda s: s.update(before=list(s["after"])), {"resume_snapshot_mismatch", "resume_call_evidence", "reprocessed_checkpoint"}),
    "no claims": (lambda s: s["claims"].clear(), {"missing_claims"}),
    "a claim's value": (lambda s: s["claims"][0].__setitem__(3, "9"), {"claim_mismatch"}),
    "a rank left out": (lambda s: s["ranking"].pop(), {"ranking_mismatch", "ranking_length"}),
    "a complaint in no issue": (lambda s: s["membership"].pop(), {"ungrouped_complaints"}),
    "praise in an issue": (lambda s: s["membership"].append([s["membership"][0][0], "r13"]), {"noncomplaint_in_ranking"}),
    # files
    "no claims file": (raw("claims.csv", None), {"unreadable_file", "missing_claims"}),
    "a header without a column": (raw("claims.csv", b"claim_id,issue_id,metric\nCL-001,a,b\n"), {"unreadable_file", "missing_claims"}),
    "a sheet with a row too long": (lambda s: s["membership"].append(["IS-x", "r01", "more"]), {"unreadable_file"}),
    "both forms of the records": (raw("records.jsonl.gz", gzip.compress(b"{}\n")), {"ambiguous_file"}),
    "lines that are no JSON": (lambda s: s["raw"].__setitem__("checkpoint_before.json", b'{"review_id":"r01"}\n{"review_id":"r02"\n{"review_id":"r03","review_id":"r04"}\n[1]\n{"review_id":"\xff"}\n'), {"malformed_jsonl"}),
}


@pytest.fixture(scope="module")
def quick(spark) -> Iterator:
    """Plans of many small tables: one partition, no plan changes on the way."""
    changed = {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false", "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def raised(quick, tmp_path_factory) -> dict[str, list]:
    """What each folder raises. Most of the time goes to planning, so several are planned at once."""
    source = quick.createDataFrame([(k, sha(t), t) for k, t in TEXTS.items()], "review_id string, source_sha256 string, review_text string").checkpoint() if shared_dir(quick) else None

    top = tmp_path_factory.mktemp("exports")

    def one(name: str) -> list:
        folder, state = top / hashlib.sha256(name.encode()).hexdigest()[:12], base()
        folder.mkdir()
        CASES[name][0](state)
        put(state, folder)
        export = read_export(quick, str(folder))
        return export.faults.unionByName(audit.export_violations(export.tables, source)).collect()

    with ThreadPoolExecutor(6) as pool:
        return dict(zip(CASES, pool.map(one, CASES), strict=True))


@pytest.mark.parametrize("name", CASES)
def test_folder_raises_its_codes(raised, name):
    assert {r["code"] for r in raised[name]} == CASES[name][1], sorted(map(tuple, raised[name]))


def test_bad_lines_are_named(raised):
    assert {r["detail"] for r in raised["lines that are no JSON"]} == {f"checkpoint_before.json:{n}" for n in (2, 3, 4, 5)}


def test_only_texts_beyond_ascii_are_folded_in_python(spark):
    import pyarrow as pa

    texts = ["Straße", "STRASSE", " strasse　", "é", "é", "", "A b", "a  b"]
    df = spark.createDataFrame([(t,) for t in texts], "review_text string")
    found = {r["form"]: r["distinct_texts"] for r in corpus.dedup_variants(df).collect()}
    assert found == {"casefold": 6, "nfc": 7, "exact": 8, "stripped": 8, "lowered": 7, "collapsed": 6}
    assert corpus.folded_and_composed()(pa.array([None, "x"])).to_pylist()[0] == {"casefold": None, "nfc": None}
