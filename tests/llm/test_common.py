from kabuto.llm import common, ngram_join


def test_a_worker_lets_go_of_what_an_earlier_step_kept(monkeypatch):
    now = [100.0]
    monkeypatch.setattr(common, "_kept", {})
    monkeypatch.setattr(common.time, "monotonic", lambda: now[0])
    common.kept("pieces")["model"] = 1
    now[0] += common.IDLE_SECONDS / 2
    common.kept("toxicity")["model"] = 2  # both in use
    assert common.kept("pieces") == {"model": 1}
    now[0] += 2 * common.IDLE_SECONDS
    assert common.kept("toxicity") == {"model": 2} and list(common._kept) == ["toxicity"]
    assert common.kept("pieces") == {}


def test_the_join_lets_go_of_what_earlier_steps_kept(monkeypatch):
    monkeypatch.setattr(common, "_kept", {"toxicity": [common.time.monotonic() - 2 * common.IDLE_SECONDS, {"model": 1}]})
    assert list(ngram_join._met(iter([]))) == []
    assert "toxicity" not in common._kept
