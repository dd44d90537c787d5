"""Secrets that reach a sensitive name by a constant or a subscript."""

from firnline.llm import secrets


def clean(text):
    return secrets.redact(text, secrets.find_spans(text))


def lexed(text):
    return [text[a:b] for k, a, b in secrets.find_spans(text) if k == "lexed"]


def test_the_literal_behind_a_constant_is_a_span():
    text = 'A = "hunter2xyz9"\ndb_password = A\n'
    assert lexed(text) == ['"hunter2xyz9"', "A"] and clean(text) == "A = <SECRET>\ndb_password = <SECRET>\n"
    assert lexed("A: hunter2xyz9\ndb_pwd: A\nother_pwd: A\n") == ["hunter2xyz9", "A", "A"]


def test_chains_and_concatenations_keep_all_literals():
    text = "A = 'hunter2'\nB = A + \"xyz9\"\nC = B\nshown = 'hunter2'\ndb_pwd = C\n"
    assert lexed(text) == ["'hunter2'", '"xyz9"', "C"] and "hunter2" not in clean(text).replace("shown = 'hunter2'", "")
    rebound = 'A = "hunter2xyz9"\ndb_pwd = A\nA = "blue"\ncolor = A\n'
    assert lexed(rebound) == ['"hunter2xyz9"', "A"]


def test_a_literal_is_reported_once():
    assert lexed('my_pwd = "hunter2xyz9"\ndb_pwd = my_pwd\n') == ["hunter2xyz9", "my_pwd"]


def test_subscript_keys_name_the_target():
    for target in (
        'config["password"]', "os.environ['DB_PASSWORD']", 'cfg["db"]["password"]', "cfg['password'][0]", "$cfg['a']['db_password']['x']", "settings[:password]",
        'form["user[password]"]', 'users[ids[0]]["password"]', 'c [ "password" ]', f'c["{"long_" * 60}password"]', f'c["password"]["{"k" * 300}"]', 'conf["api_key"]', 'load()["password"]', 'a[b[c[0]]]["password"]',
    ):
        text = f'{target} = "hunter2xyz9"\n'
        assert lexed(text) == ["hunter2xyz9"] and "hunter2" not in clean(text), target
    for harmless in ('config["color"]', "cfg[password]", 'cfg["db"]["host"]', "x[0]"):
        assert lexed(f'{harmless} = "hunter2xyz9"\n') == [], harmless
    assert [n for n, *_ in secrets.lex('cfg["db"]["password"] = "x"')] == ["password\ndb\ncfg"]
    assert lexed('password["hint"] = "hunter2xyz9"\n') == ["hunter2xyz9"]


def test_constants_by_subscript():
    text = 'd["x"] = "hunter2xyz9"\nd["y"] = "blue"\ndb_pwd = d["x"]\n'
    assert lexed(text) == ['"hunter2xyz9"', 'd["x"]'] and "hunter2" not in clean(text) and "blue" in clean(text)


def test_long_lines_of_brackets_end():
    for unit in ("]=", '"]=', '["k"]', "[a]=", '\\"]=', "[[", "]] "):
        secrets.find_spans(unit * 20000 + " = x")
