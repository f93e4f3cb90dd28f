import io
import json
import re
import zipfile
from pathlib import Path

import numpy as np
import pytest

from tidemark import cli
from tidemark.plans.findings import Report, advise, fix, hard, info, loss
from tidemark.plans.prepare import prep
from tidemark.plans.profile import Profile, ProfileError
from tidemark.plans.quality import quality_report, separability
from tidemark.plans.validate import validate
from tidemark.sources import intake, recordings, sinks

BASE = {
    "dataset_name": "t", "label_column": "class", "sensor_columns": ["acc_x", "acc_y", "acc_z"], "separator": "comma", "task_type": "multiclass_classification",
    "class_encoding": {"map": {"idle": 0, "left": 1, "right": 2}, "continuous_classes": [0], "gesture_classes": [1, 2]}, "window": {"candidates": [20], "shift": 20}, "sampling_rate_hz": 100,
}


def profile(**changes):
    return Profile.from_dict(BASE | changes)


def block(n, label, peaks=(), seed=0):
    x = np.random.default_rng(seed + label).normal(0, 0.01, (n, 3))
    for p in peaks:
        x[p - 1 : p + 2, 2] += 6
    return [[*map(lambda v: f"{v:.6f}", row), str(label)] for row in x]


def write(path, rows, header=("acc_x", "acc_y", "acc_z", "class"), end="\n", sep=","):
    Path(path).write_text(end.join(sep.join(r) for r in [header, *rows]) + end, newline="")
    return str(path)


@pytest.mark.parametrize(
    ("data", "code"),
    [
        (b"a,b\r\n1,2\n", "mixed_line_endings"), (b"a,b\r1,2\r", "cr_only_line_endings"), (b"ab\n12\n", "no_delimiter_found"), (b"1,2\n3,4\n", "missing_header"),
        (b"a,b\n1,2,3\n", "field_count_mismatch"), ("a,b\n1,2\n".encode("utf-16"), "encoding_not_supported"), (b"a,b\n1,\x00\n", "encoding_not_supported"),
    ],
)
def test_sniff_codes(data, code):
    assert code in {f.code for f in intake.sniff_bytes(data).findings}


def test_sniff_clean():
    s = intake.sniff_bytes("ä;b\r\n1;2\r\n".encode("latin-1"))
    assert (s.encoding, s.line_endings, s.delimiter, s.has_header, s.findings) == ("iso-8859-1", "crlf", ";", True, [])


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k, v in members.items():
            z.writestr(k.replace("__SLASH__", "/"), v)
    return out.getvalue()


def test_zip_members():
    assert intake.zip_member(zipped(**{"a.csv": "x,y\n1,2\n"}))[0] == b"x,y\n1,2\n"
    body, name, said = intake.zip_member(zipped(**{"a.csv": "x", "readme.txt": "y", "__MACOSX/a": "z"}))
    assert (body, name, [f.code for f in said]) == (b"x", "a.csv", ["zip_extra_members"])
    for data, code in ((zipped(), "zip_empty"), (zipped(**{"a.csv": "1", "b.csv": "2"}), "zip_multiple_files"), (b"nope", "zip_unreadable"), (zipped(**{"a.csv": ""}), "zip_member_empty")):
        assert code in {f.code for f in intake.zip_member(data)[2]}
    assert "zip_inner_file_name" in {f.code for f in intake.zip_member(zipped(**{"a b.csv": "x"}))[2]}


def test_rows_keep_their_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", [[str(i), "", "NA", str(i % 3)] for i in range(5000)])
    rows = recordings.read_strings(spark, path).orderBy("_row").collect()
    assert [r.acc_x for r in rows] == [str(i) for i in range(5000)]
    assert (rows[0].acc_y, rows[0].acc_z, rows[7]._row) == ("", "NA", 7)


@pytest.mark.parametrize(("v", "text"), [(None, ""), (1.0, "1"), (1e-7, "0.0000001"), (float("nan"), ""), (0.1, "0.1"), (12345678901234567890, "12345678901234567890"), ("x", "x"), (1e20, "100000000000000000000")])
def test_format_value(v, text):
    assert sinks.format_value(v) == text


def test_verdicts():
    assert Report([info("a", "")]).verdict == "PASS"
    assert Report([loss("a", ""), advise("b", "")]).exit_code == 3
    assert Report([loss("a", ""), fix("b", "")]).exit_code == 2
    assert Report([hard("a", "")]).verdict == "FIX_REQUIRED"


@pytest.mark.parametrize("bad", [{"separator": "dot"}, {"task_type": "x"}, {"sensor_columns": []}, {"signal_processing": 1}, {"sampling_rate_hz": 0}, {"class_encoding": {"map": {"a": 1}}}, {"label_column": "acc_x"}])
def test_profile_rules(bad):
    with pytest.raises(ProfileError):
        profile(**bad)


def test_profile_says_all_that_is_wrong():
    with pytest.raises(ProfileError) as e:
        profile(separator="dot", task_type="x", sampling_rate_hz=-1)
    assert all(x in str(e.value) for x in ("separator", "task_type", "sampling_rate_hz"))
    with pytest.raises(ProfileError, match="gesture and continuous"):
        profile(class_encoding={"map": {"a": 0, "b": 1}, "gesture_classes": [1], "continuous_classes": [1]})


def test_zip_choice():
    kept = lambda **m: intake.zip_member(zipped(**m))[1]
    assert kept(**{".hidden.csv": "x"}) == ".hidden.csv"
    assert kept(**{".hidden.csv": "x", "a.txt": "y"}) == "a.txt"
    assert kept(**{"b.csv": "x", "a.txt": "y", "d__SLASH__": ""}) == "b.csv"
    out = io.BytesIO()
    with pytest.warns(UserWarning), zipfile.ZipFile(out, "w") as z:
        for _ in range(2):
            z.writestr("a.csv", "x,y\n1,2\n")
    assert intake.zip_member(out.getvalue())[:2] == (b"x,y\n1,2\n", "a.csv")


def test_validate_passes_and_loses(spark, tmp_path):
    good = write(tmp_path / "good.csv", block(60, 0) + block(60, 1) + block(60, 2))
    assert validate(spark, good, profile(), 20).verdict == "PASS"
    short = write(tmp_path / "short.csv", block(60, 0) + block(12, 1) + block(30, 0) + block(12, 1) + block(60, 2))
    r = validate(spark, short, profile(), 20)
    assert (r.verdict, "class_run_below_window" in r.codes()) == ("WILL_LOSE_DATA", True)


def test_validate_codes(spark, tmp_path):
    rows = block(60, 0) + block(60, 1)
    rows[3][0], rows[4][1] = "", "x"
    path = write(tmp_path / "bad!.csv", [[str(i), *r] for i, r in enumerate(rows)], ("row", "acc_x", "acc_y", "acc_z", "class"))
    codes = validate(spark, path, profile(window={"candidates": [5], "shift": 9}), 5).codes()
    assert {"empty_or_na_value", "non_numeric_value", "index_column_present", "bad_file_name", "window_out_of_range", "shift_exceeds_window", "recommended_dtype"} <= codes
    off = validate(spark, path, profile(signal_processing=False), None, False).codes()
    assert {"sp_off_unverified", "sp_off_contradicts_profile"} <= off
    assert not {"window_out_of_range", "class_run_below_window"} & off
    gone = validate(spark, path, profile(label_column="target"), 20)
    assert "label_column_missing" in gone.codes()


def test_prep_centres_and_writes(spark, tmp_path):
    peaks = list(range(30, 600, 60))
    path = write(tmp_path / "g.csv", block(130, 0) + block(600, 1, peaks) + block(600, 2, peaks))
    out = str(tmp_path / "out.csv")
    made = prep(spark, [path], profile(), out, 20)
    assert made.written, made.report.to_text()
    lines = Path(out).read_text().splitlines()
    assert lines[0] == "acc_x,acc_y,acc_z,class"
    assert [x.rsplit(",", 1)[1] for x in lines[1:]] == ["0"] * 120 + ["1"] * 200 + ["2"] * 200
    assert json.loads(Path(made.dictionary_path).read_text()) == BASE["class_encoding"]["map"]
    for i in range(10):
        z = [abs(float(x.split(",")[2])) for x in lines[121 + 20 * i : 141 + 20 * i]]
        assert abs(z.index(max(z)) - 10) <= 1


def test_prep_guards(spark, tmp_path):
    path = write(tmp_path / "a.csv", block(60, 0) + block(60, 1) + block(60, 2))
    assert prep(spark, [path], profile(), path, 20).report.codes() == {"output_overwrites_input"}
    assert prep(spark, [path], profile(), str(tmp_path / "o.zip"), 20).report.codes() == {"output_not_csv"}
    other = write(tmp_path / "b.csv", [["1", "2", "0"]], ("acc_x", "acc_y", "class"))
    assert "combine_failed" in prep(spark, [path, other], profile(), str(tmp_path / "o.csv"), 20).report.codes()


def test_prep_resamples(spark, tmp_path):
    rows = [[*r[:3], f"{i / 50:.2f}", r[3]] for i, r in enumerate(block(50, 0) + block(30, 1))]
    path = write(tmp_path / "t.csv", rows, ("acc_x", "acc_y", "acc_z", "t", "class"))
    out = str(tmp_path / "o.csv")
    p = profile(time_column="t", class_encoding=None)
    made = prep(spark, [path], p, out, 20, center=False, target_rate=100.0, write_anyway=True)
    lines = [x.split(",") for x in Path(out).read_text().splitlines()]
    assert {"resample_provenance"} <= made.report.codes()
    assert len(lines) - 1 in range(155, 160)
    assert {x[-1] for x in lines[1:]} == {"0", "1"}


def test_quality_and_separability(spark, tmp_path):
    paths = []
    for k, scale in enumerate((1, 1, 10)):
        x = np.random.default_rng(k).normal(0, scale, (120, 3))
        paths.append(write(tmp_path / f"s{k}.csv", [[*map(str, row), "0"] for row in x]))
    report, extra = quality_report(spark, paths, profile(), 20)
    assert {f.data["source"] for f in report.findings if f.code == "source_outlier"} == {"s2.csv"}
    assert set(extra["sources"]) == {"s0.csv", "s1.csv", "s2.csv"}
    ramp = [("", i, float(s * (i % 20)), 0.0 if s > 0 else 1.0) for s, off in ((1, 0), (-1, 120)) for i in range(off, off + 120)]
    df = spark.createDataFrame([(s, p, 240, x, int(c)) for s, p, x, c in ramp], "session string, pos long, n long, x double, label long")
    got = separability(df, ["x"], 20)
    assert got["ok"] and len(got["magnitude_blind_pairs"]) == 1
    assert separability(df, ["x"], 20) == got


def test_cli(tmp_path, capsys):
    prof = tmp_path / "p.json"
    prof.write_text(json.dumps(BASE))
    good = write(tmp_path / "good.csv", block(60, 0) + block(60, 1) + block(60, 2))
    assert cli.main(["validate", good, "--profile", str(prof), "--json"]) == 0
    assert json.loads(capsys.readouterr().out)["verdict"] == "PASS"
    assert cli.main(["validate", good, "--profile", str(tmp_path / "none.json")]) == 4
    assert cli.main(["validate", good]) == 4
    assert cli.main(["quality-report", good, "--profile", str(prof), "--window", "0"]) == 4


def test_rule_refs_resolve():
    root = Path(__file__).resolve().parents[1]
    anchors = set(re.findall(r"^## (\w+)$", (root / "docs/rules.md").read_text(), re.M))
    for path in root.glob("tidemark/**/*.py"):
        if "llm" not in path.parts:
            for code in re.findall(r'(?:hard|fix|loss|advise|info)\(\s*"([a-z_]+)"', path.read_text()):
                assert code in anchors, code
