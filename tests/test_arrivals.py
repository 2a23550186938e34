"""Sets of files that are shown when they are complete."""

from salesmart.sources import arrivals, files
from samples import as_set


def test_sets_wait_for_their_last_file(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, v string").schema
    path = lambda name: str(tmp_path / "in" / name)
    expected = {"d1": [path("d1_a.csv"), path("d1_b.csv")], "d2": [path("d2_a.csv"), path("d2_b.csv")]}
    (tmp_path / "in").mkdir()

    def arrive(name, *rows):
        (tmp_path / "in" / name).write_text("id,v\n" + "".join(f"{r}\n" for r in rows))

    def run():
        got = arrivals.load_complete_sets(
            spark, expected, schema, str(tmp_path / "out"), str(tmp_path / "log"), lambda paths: files.read_staging_csv(spark, paths, schema))
        return as_set(got.rows, "file_set", "id", "v"), got.loaded, got.missing

    everything = {"d1": expected["d1"], "d2": expected["d2"]}
    assert run() == (set(), [], everything)
    arrive("d1_a.csv", "1,x", "2,y")
    arrive("d2_b.csv", "3,z")
    arrive("other.csv", "9,o")
    assert run() == (set(), [], {"d1": [path("d1_b.csv")], "d2": [path("d2_a.csv")]})
    arrive("d1_b.csv")  # no rows, but it is there
    shown = {("d1", 1, "x"), ("d1", 2, "y")}
    assert run() == (shown, ["d1"], {"d2": [path("d2_a.csv")]})
    assert run() == (shown, [], {"d2": [path("d2_a.csv")]})
    arrive("d2_a.csv", "4,w")
    shown |= {("d2", 3, "z"), ("d2", 4, "w")}
    assert run() == (shown, ["d2"], {})
    arrive("d1_a.csv", "1,changed now")
    shown = {("d1", 1, "changed now"), ("d2", 3, "z"), ("d2", 4, "w")}
    assert run() == (shown, ["d1"], {})
    arrive("d1_a.csv")
    assert run() == ({("d2", 3, "z"), ("d2", 4, "w")}, ["d1"], {})
    assert run()[1:] == ([], {})
