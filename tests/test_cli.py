"""The jobs from the command line, chained as they are used."""

import pytest
from helpers import TopicFolder, at

from obslayers.cli import parser, run
from obslayers.sources.tables import read_table


def test_layers_end_to_end(spark, tmp_path, capsys):
    folder = TopicFolder(spark, tmp_path / "topic")
    folder.add(at("00:00:00", 280, "a"), at("00:07:00", 282, "b"), "hello", None)
    names = "raw new clean hourly speed daily daily2 table parts lines result c1 c2 c3 c4".split()
    where = {name: str(tmp_path / name) for name in names}

    def job(*words):
        run(spark, parser().parse_args([str(word) for word in words]))
        return capsys.readouterr().out

    topic = ["--folder", folder.topic.folder]
    job("raw", *topic, "--table", where["raw"])
    job("raw", *topic, "--table", where["new"], "--checkpoint", where["c1"])
    assert read_table(spark, where["raw"]).count() == read_table(spark, where["new"]).count() == 3
    live = [*topic, "--starting", "earliest", "--once"]
    job("speed", *live, "--view", where["speed"], "--checkpoint", where["c2"])
    whole = ["--raw", where["raw"], "--table", where["table"], "--view", where["daily"]]
    assert "rows: 2" in job("daily", *whole, "--show")
    new = ["--raw", where["new"], "--parts", where["parts"], "--checkpoint", where["c3"]]
    job("daily", *new, "--view", where["daily2"])
    job("archive", *live, "--table", where["clean"], "--checkpoint", where["c4"], "--by-day")
    job("hourly", "--clean", where["clean"], "--table", where["hourly"])
    assert read_table(spark, where["hourly"]).count() == 2
    assert "|b" in job("summary", "--clean", where["clean"])
    assert "T=6.85°C" in job("replay", *topic, "--rows", 5)
    job("replay", *topic, "--table", where["lines"])
    assert read_table(spark, where["lines"]).count() == 3
    assert "epochs folded" in job("compact", "speed", "--view", where["speed"])
    assert "epochs folded: 0" in job("compact", "parts", "--view", where["parts"])
    for sql in ("SELECT * FROM speed LIMIT 10", "SELECT * FROM batch_view LIMIT 10"):
        assert "\nb\t" in job("query", sql, "--speed", where["speed"], "--daily", where["daily"])
    assert "\nb\t" in job("query", "SELECT * FROM batch_view", "--daily", where["daily2"])
    many = job("query", "SELECT explode(sequence(1, 45)) AS n FROM batch_view LIMIT 45", "--daily", where["daily2"])
    assert len(many.split()) == 46
    job("query", "SELECT * FROM batch_view", "--daily", where["daily2"], "--output", where["result"])
    assert read_table(spark, where["result"]).count() == 2


def test_missing_options(spark, tmp_path):
    with pytest.raises(SystemExit):
        parser().parse_args(["speed", "--view", "v", "--checkpoint", "c"])
    words = ["speed", "--folder", str(tmp_path), "--checkpoint", "c", "--once"]
    with pytest.raises(SystemExit):
        run(spark, parser().parse_args(words))
    with pytest.raises(SystemExit):
        run(spark, parser().parse_args(["daily", "--raw", "r", "--parts", "p"]))
