import pytest
from pyspark.sql import functions as F

from tunelake.functions.chattemplate import compile_template
from tunelake.operators import chat

CONVERSATIONS = [
    [("user", "hi "), ("assistant", "yo")], [("system", "s"), ("user", " a"), ("assistant", None)], [], None,
    [("tool", "t")], [(None, "x"), ("user", "")],
]


@pytest.fixture(scope="module")
def talks(spark):
    rows = spark.createDataFrame(list(enumerate(CONVERSATIONS)), "i int, m array<struct<role string, content string>>")
    calls = F.array(F.parse_json(F.lit('{"function": {"name": "f", "n": 3, "none": null}}')))
    return rows.select("i", F.transform("m", lambda m: F.struct(
        m["role"].alias("role"), m["content"].alias("content"), F.when(m["role"] == "assistant", calls).alias("tool_calls"))).alias("messages"),
        F.when(F.col("i") == 0, F.parse_json(F.lit('[{"name": "look"}, {"name": "go"}]'))).alias("tools"))


def texts(talks, template, **names):
    made = talks.select("i", compile_template(template, **names)(F.col("messages"), F.col("tools")).alias("t"))
    return [r.t for r in made.orderBy("i").collect()]


def each(template, talks, **names):
    return texts(talks, "{% for m in messages %}" + template + "{% endfor %}", **names)


def test_a_template_with_the_fallbacks_meaning(talks):
    own = """
    {%- for m in messages %}
        {%- set name = 'model' if m.role == 'assistant' else m.role %}
        {%- if m['role'] in ('user', 'system', 'assistant') -%}
            <start_of_turn>{{ name }}{{ '\\n' + m['content'] + '<end_of_turn>\\n' }}
        {%- endif %}
    {%- endfor %}"""
    want = [r.t for r in talks.select("i", chat.render(F.col("messages")).alias("t")).orderBy("i").collect()]
    assert texts(talks, own) == want
    assert [r.text for r in chat.render_with(talks, own).orderBy("i").collect()] == want


def test_white_space_rules(talks):
    template = "a\n  {% if true %}\nb {# note #}\n\t{%+ if false %}no{% endif %}\n {{- 'c' }}\n\n  {{ 'd' -}} \n e\n{% endif %}\nf\n\n"
    assert texts(talks, template)[0] == "a\nb \tc\n\n  de\nf\n"


def test_variables_slices_and_refusal(talks):
    template = """{{- bos_token }}
{%- if messages[0].role == 'system' %}
    {%- set system, = messages %}
{% endif %}"""
    with pytest.raises(ValueError, match="set system"):
        texts(talks, template)
    template = """{{- bos_token }}
{%- if messages[0]['role'] == 'system' %}
    {%- set system = messages[0].content.strip() | upper %}
    {%- set rest = messages[1:] %}
{%- else %}
    {%- set rest = messages %}
{%- endif %}
{% for m in rest %}
    {% if m.role not in ['user', 'assistant'] %}{{ raise_exception('role ' ~ m.role) }}{% endif %}
{{ loop.index }}/{{ loop.length }} {{ m.role }}: {{ m.content if m.content is not none else '-' }}
    {%- for c in m.tool_calls %}
 [{{ c.function.name }} {{ c['function']['n'] }}{{ c.function.none }}{{ c.other }}]
    {%- endfor %}

{% endfor %}
{%- if system %}S={{ system }}{% endif %}"""
    assert texts(talks, template, bos_token="<s>") == [
        "<s>1/2 user: hi \n2/2 assistant: yo [f 3None]\n", "<s>1/2 user:  a\n2/2 assistant: - [f 3None]\nS=S", "<s>", None, None, None]
    with pytest.raises(Exception, match="conversation refused: role tool"):
        texts(talks.filter("i = 4"), template, strict=True)


def test_values(talks):
    def one(expression, **names):
        return texts(talks.filter("i = 1"), "{{ " + expression + " }}", **names)[0]

    for expression, want in {
        "messages | length": "3", "messages[-1].content is none": "True", "messages[5].content is none": "True", "nothing": "",
        "nothing is defined": "False", "tools is none": "True", "not tools and 1 < 2": "True", "'a|b~c' ~ 1": "a|b~c1",
        "messages[:-1][-1].content.strip().split('x')[0]": "a", "'a.b.c'.split('.')[-1]": "c", "7 % 4 - 1": "2",
        "'s' in messages[0]['content']": "True", "messages[0].content.startswith('t') or messages[0].content.endswith('s')": "True",
        "messages[9:] | length": "0", "messages[-2:] | length": "2", "nothing or 'x' == 'x'": "True", "nothing | default('d')": "d",
        "messages[0].role == none": "False", "messages[2].content == none": "True", "1 == '1'": "False", "'x' if false else n": "4",
        '"line\nend"': "line\nend", "messages[0].name is undefined": "True", "(messages | first).role | upper | lower": "system",
    }.items():
        assert one(expression, n=4) == want, expression


def test_tools_and_places(talks):
    template = "{% if tools is not none %}{% for t in tools %}{{ t.name }}{{ '' if loop.last else ',' }}{% endfor %}:{% endif %}"
    assert texts(talks, template) == ["look,go:", "", "", None, "", ""]
    assert each("{{ loop.index0 }}{% if not loop.last %},{% endif %}", talks) == ["0,1", "0,1,2", "", None, "0", "0,1"]


def test_what_has_no_column_form_is_refused_at_once(talks):
    for template in ("{% set ns = namespace(a=1) %}", "{{ tools | tojson }}", "{% macro f() %}{% endmacro %}", "{{ messages }}",
                     "{% if true %}", "{{ 1 + }}", "{% for m in messages %}{{ m.role.replace('a', 'b') }}{% endfor %}"):
        with pytest.raises(ValueError):
            texts(talks, template)


def test_a_template_stays_on_the_jvm(talks):
    made = talks.select(compile_template("{% for m in messages %}{{ m.content | trim }}{% endfor %}")(F.col("messages"), F.col("tools")))
    assert "Python" not in made._jdf.queryExecution().toString()
