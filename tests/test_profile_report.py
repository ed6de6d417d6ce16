"""The profile as one JSON document against a plain count over the grammar
model's records."""

import glob
import json
import os
import tempfile
from collections import Counter, defaultdict

from conftest import lines_df

from logsift.functions import fixed
from logsift.operators.profile_parse import parse_profile_lines
from logsift.operators.profile_report import SAMPLE_FIELDS, UNPARSEABLE_SAMPLES, profile_counts, profile_document, profile_samples
from logsift.plans.job import run_profile_job
from logsift.sinks.writers import write_profile_document
from model import parse_profile
from test_sessions import VOCAB

TS = "01.02.2024_10:00:00"
MORE = [
    f'QS {TS} {{say "hi" \\ ты}} ACC_1 XY_2', f"QS {TS} {{ }}", "QS Mon,_1_Jan_2024_10:00:00_+0300 {a}", f"QS {TS} no braces",
    "-5 ACC_1 ACC_2", f"DOC_OPEN {TS} 7 odd-id", "bad'quote x", 'bad"quote', "$12 free text", "\ttabs\there ", "CARD_SEARCH_END x y",
]


def plain_report(sessions):
    """The document of {file: lines}, read in numeric file order."""
    n, top, samples, bad = Counter(), defaultdict(Counter), defaultdict(list), []
    for sid in sorted(sessions, key=int):
        seen = False
        for line in sessions[sid]:
            p = {k: v for k, v in parse_profile(line).items() if v is not None} | {"raw": line}
            rt = p["record_type"]
            if rt == "EMPTY":
                n["empty_lines"] += 1
                continue
            seen = True
            n["total_events"] += 1
            top["type"][rt] += 1
            if "parse_error" in p:
                top["error"][p["parse_error"]] += 1
                bad.append({"line": p["raw"][:200], "error": p["parse_error"]})
            samples[rt].append({"raw": p["raw"][:160], "fields": {k: p[k] for k in SAMPLE_FIELDS if k in p}})
            qs = rt == "QUICK_SEARCH"
            n["qs_empty_query"] += qs and "query_text" in p and not p["query_text"].strip()
            n["timestamp_http_format_lines"] += qs and p["timestamp"][0].isalpha()
            n["qs_inline_doc_ids"] += bool(qs and p.get("document_ids_inline"))
            n["negative_search_id_lines"] += rt == "SEARCH_RESULTS" and p["search_id"].startswith("-")
            n["doc_open_with_ts"] += rt == "DOCUMENT_OPEN"
            n["doc_open_no_ts"] += rt == "DOCUMENT_OPEN_NO_TS"
            if rt == "SEARCH_RESULTS":
                top["size"][len(p["document_ids"])] += 1
            if rt == "CARD_SEARCH_QUERY":
                top["param"][p["card_param"]] += 1
                n["card_query_with_doc_id"] += "document_id" in p
            if "timestamp" in p:
                top["date"][p["timestamp"].split("_", 1)[0]] += 1
            for i in [*p.get("document_ids", ()), *([p["document_id"]] if "document_id" in p else [])]:
                top["prefix"][i.split("_", 1)[0]] += 1
        n["files_processed"] += seen
    best = lambda k, m: sorted(top[k].items(), key=lambda x: (-x[1], x[0]))[:m]
    commands = Counter()
    for rt, c in top["type"].items():
        commands[dict(fixed.LEGACY_COMMANDS).get(rt, rt)] += c
    return {
        "files_processed": n["files_processed"],
        "total_events": n["total_events"],
        "empty_lines": n["empty_lines"],
        "unparseable_lines": top["type"]["UNPARSEABLE"],
        "record_counts": dict(best("type", None)),
        "samples_by_type": {k: v[:2] for k, v in samples.items()},
        "qs_empty_query": n["qs_empty_query"],
        "timestamp_http_format_lines": n["timestamp_http_format_lines"],
        "qs_inline_doc_ids": n["qs_inline_doc_ids"],
        "negative_search_id_lines": n["negative_search_id_lines"],
        "doc_open_with_ts": n["doc_open_with_ts"],
        "doc_open_no_ts": n["doc_open_no_ts"],
        "card_param_counts": dict(best("param", None)),
        "card_query_with_doc_id": n["card_query_with_doc_id"],
        "doc_prefixes_top30": [list(x) for x in best("prefix", 30)],
        "search_results_doc_count_distribution": {str(k): v for k, v in best("size", 20)},
        "date_formats_top20": [list(x) for x in best("date", 20)],
        "parse_errors": dict(best("error", None)),
        "unparseable_samples": bad[:UNPARSEABLE_SAMPLES],
        "commands": {k: {"total_occurrences": v} for k, v in sorted(commands.items())},
    }


def written_document(out):
    parts = sorted(glob.glob(f"{out}/log_analysis_stats.json/part-*"))
    return "".join(open(p, encoding="utf-8").read() for p in parts), len(parts)


def sessions():
    vocab = [*VOCAB, *MORE]
    out = {str(s): [vocab[(s * 7 + i * i) % len(vocab)] for i in range(12 + s % 5)] for s in range(1, 40)}
    out |= {"50": ["", "  "], "51": [f"{k} " + " ".join(f"P{'ABCDEFGHIJ'[k % 10]}{'KLMNO'[k % 5]}_{j}" for j in range(k)) for k in range(35)]}
    out |= {"52": [f"SESSION_START {d:02d}.03.2024_10:00:00" for d in range(1, 29)], "53": [f"junk{k}" for k in range(40)]}
    return out


def test_document_layout_against_a_plain_count(spark):
    lines = sessions()
    precs = parse_profile_lines(lines_df(spark, lines))
    document = profile_document(profile_counts(precs), profile_samples(precs))
    for single in (False, True):
        out = tempfile.mkdtemp(prefix="logsift-report-")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(single).lower())  # or a few small ranges become one
        write_profile_document(document, out, single_file=single)
        text, parts = written_document(out)
        got = json.loads(text)
        want = plain_report(lines)
        formats = got.pop("record_formats")
        assert list(got) == list(want)
        for member, value in want.items():
            assert got[member] == value, member
        for member in ("record_counts", "card_param_counts", "parse_errors", "search_results_doc_count_distribution", "commands"):
            assert list(got[member]) == list(want[member]), member  # most frequent first
        assert list(formats) == [t for t, _, _ in fixed.RECORD_FORMATS]
        assert formats["QUICK_SEARCH"]["fields"]["query_text"] and "notes" not in formats["SESSION_END"]
        assert parts == 1 if single else parts > 1


def test_document_of_no_lines(spark):
    precs = parse_profile_lines(lines_df(spark, {"1": ["x"]}).limit(0))
    out = tempfile.mkdtemp(prefix="logsift-report-")
    write_profile_document(profile_document(profile_counts(precs), profile_samples(precs)), out)
    got = json.loads(written_document(out)[0])
    got.pop("record_formats")
    assert got == plain_report({})


def test_counts_read_the_records_once(spark):
    path = tempfile.mkdtemp(prefix="logsift-lines-") + "/t"
    lines_df(spark, sessions()).write.parquet(path)
    precs = parse_profile_lines(spark.read.parquet(path))
    document = profile_document(profile_counts(precs), profile_samples(precs))
    document.collect()
    plan = document._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    # every count comes from one read, every sample from one more
    assert final.count("FileScan parquet") == 2 and "ReusedExchange" in final
    assert "WindowGroupLimit" in final and "CartesianProduct" not in final and "NestedLoop" not in final


def test_profile_job_writes_one_document(spark):
    lines = {k: v for k, v in sessions().items() if k != "50"}
    root = tempfile.mkdtemp(prefix="logsift-flat-")
    for sid, ls in lines.items():
        with open(os.path.join(root, sid), "w", encoding="utf-8", newline="") as f:
            f.write("\n".join(ls) + "\n")
    out = tempfile.mkdtemp(prefix="logsift-out-")
    run_profile_job(spark, root, out, single_file=True)
    got = json.loads(written_document(out)[0])
    got.pop("record_formats")
    assert got == plain_report(lines)
