import pytest
from pyspark import cloudpickle

from mediacurate.sources import files


def below(uri):
    for child in files.children(uri):
        yield child
        if child[1]:
            yield from below(child[0])


@pytest.mark.parametrize("root", ["mock://", "local"])
def test_tree_on_any_file_system(root, tmp_path):
    if root == "local":
        root = f"file://{tmp_path}"
    top = f"{root}/data" if root != "mock://" else "mock:///data"
    files.write_bytes(f"{top}/00000/a.jpg", b"head" + bytes(200) + b"tail")
    files.write_bytes(f"{top}/00000/deep/b.jpg", b"")
    files.write_bytes(f"{top}/00001.parquet", b"p")
    plain = files.normalise_root(top)
    assert sorted(files.children(top)) == [(f"{plain}/00000", True, 0), (f"{plain}/00001.parquet", False, 1)]
    found = sorted((path, length) for path, is_dir, length in below(top) if not is_dir)
    assert found == [(f"{plain}/00000/a.jpg", 208), (f"{plain}/00000/deep/b.jpg", 0), (f"{plain}/00001.parquet", 1)]
    # What a listing gives can be opened again.
    with files.open_at(found[0][0]) as handle:
        assert (handle.read_at(4, 0), handle.read_at(4, 204), handle.size()) == (b"head", b"tail", 208)
    with files.open_at(found[1][0]) as handle:
        assert handle.size() == 0
    assert files.read_bytes(found[2][0]) == b"p"
    assert files.delete_file(found[2][0]) and files.delete_file(found[2][0])
    assert files.read_or_none(found[2][0]) is None
    assert list(files.children(f"{top}/nowhere")) == []


def test_frames_are_bounded():
    sizes = [len(f) for f in files.in_frames(((i,) for i in range(25)), ["i"], size=10)]
    assert sizes == [10, 10, 5]


def test_clients_do_not_travel():
    files.write_bytes("mock:///x/y", b"1")
    assert files._SYSTEMS
    sent = cloudpickle.loads(cloudpickle.dumps(files.locate))
    assert sent("mock:///x/y")[1].endswith("x/y")
    assert cloudpickle.loads(cloudpickle.dumps(files._SYSTEMS)) == {}


def test_a_stage_that_needs_the_room_drops_what_others_left():
    from mediacurate import worker

    worker.worker_table("words")["a"] = 1
    worker.forget_tables()
    assert worker.worker_table("words") == {}
