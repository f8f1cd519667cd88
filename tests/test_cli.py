"""Command line: build twice; the second run is skipped by the version gate."""

import json
import os

from tanimart.__main__ import main

from .conftest import SF_SMALL


def test_build_command_runs_and_skips(spark, scratch, capsys):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/batch_1.csv", "w") as f:
        f.write("compound_id,compound_name\n1,Item#000000003\n2,item#000000004\n")
    args = ["build", "--root", f"{scratch}/wh", "--tables", SF_SMALL, "--version", "1", "--input", f"{scratch}/in"]
    main(args)
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["similarity"]["rows"] == 20 and not first["similarity"]["skipped"]
    main(args)
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert second["similarity"]["skipped"] and all(m["skipped"] for m in second["mirror"])
