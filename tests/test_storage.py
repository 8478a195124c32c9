"""Stored tables, and the ones that a step leaves behind."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import pytest

from strandwise.storage import only_kept, stored


def folders(*tables) -> list[bool]:
    return [all(Path(urlparse(f).path).exists() for f in files) for files in tables]


def test_only_what_is_kept_stays(spark):
    outside = stored(spark.range(3))
    with only_kept(spark) as keep:
        scratch = stored(spark.range(5))
        with only_kept(spark) as inner:
            nested = inner(stored(scratch.filter("id > 1")))
            deeper = stored(spark.range(2))
            files = [t.inputFiles() for t in (scratch, nested, deeper)]
        assert folders(*files) == [True, True, False]
        kept = keep(stored(nested.filter("id > 2")))
    files.append(kept.inputFiles())
    assert folders(*files) == [False, False, False, True] and folders(outside.inputFiles()) == [True]
    assert sorted(r.id for r in kept.collect()) == [3, 4]


def test_a_failed_step_leaves_nothing(spark):
    with pytest.raises(ValueError, match="no"), only_kept(spark):
        files = stored(spark.range(5)).inputFiles()
        raise ValueError("no")
    assert folders(files) == [False]
