"""Each registered query in DuckDB SQL over the same tables.

Nothing here is used by the operators. The views restate ``views.py``; the queries state the
wanted result in the plainest form SQL has (window ranks, self-contained formulas), so that
the two sides agree only if both are right.
"""

from __future__ import annotations

from .. import fixed_values as fv
from .views import STDERRS, STDOUTS


def _text(value: str) -> str:
    """SQL text literal."""
    return "'" + value.replace("'", "''") + "'"


_SPACES = _text(fv.WHITESPACE)
_NL = "chr(10)"
# The whitespace class without the newline, in RE2 notation.
_RE_SPACE = (
    r"\t\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}"
)
_DEF = rf"[{_RE_SPACE}]*def [{_RE_SPACE}]*[^\n{_RE_SPACE}][^\n]*"
_FUNCTION = rf"(?m)^({_DEF}(?:\n(?:[ \t][^\n]*|{_DEF}|[{_RE_SPACE}]*$))*)"


def _strip(expr: str) -> str:
    return f"trim({expr}, {_SPACES})"


def _run(number: str) -> str:
    return f"lpad(cast(({number}) % 12 + 1 as varchar), 2, '0')"


def _split(i: str) -> str:
    return (
        f"case when {i} between 1 and 10 then 'prompt' when {i} between 11 and 510 then 'test' "
        f"when {i} between 511 and 600 then 'validation' else 'train' end"
    )


def _tests(i: str, plus: str) -> str:
    return (
        f"list_transform(range(1, {i} % 4 + 1), "
        f"lambda k: 'assert f_' || {i} || '(' || k || ') == ' || ({plus} + k))"
    )


def _numbered(tests: str) -> str:
    """Tests as prose, numbered from 1."""
    return (
        f"list_transform({tests}, lambda t, j: j || '. ' || "
        "replace(replace(t, 'assert ', ''), ' == ', ' should return '))"
    )


def _instruction(text: str, task: str, tests: str) -> str:
    return (
        f"{_text(fv.PROMPT_HEAD)} || {text} || {_text(fv.PROMPT_TASK)} || {task} || "
        f"{_text(fv.PROMPT_TESTS)} || array_to_string({_numbered(tests)}, {_NL}) || "
        f"{_text(fv.PROMPT_FOOT)}"
    )


def _prompt(text: str, task: str, tests: str) -> str:
    return (
        f"{_text(fv.PROMPT_HEAD)} || {text} || {_text(fv.PROMPT_TASK)} || {task} || "
        f"case when len({tests}) > 0 then {_text(fv.PROMPT_TESTS)} || "
        f"array_to_string({_numbered(tests)}, {_NL}) || {_NL} else '' end || "
        f"{_text(fv.PROMPT_FOOT)}"
    )


def _script(code: str, tests: str) -> str:
    block = _text(fv.SCRIPT_TEST.replace("{{e}}", "{e}"))
    block = f"replace(replace({block}, '{{i}}', cast(j as varchar)), '{{test}}', replace(t, 'assert ', ''))"
    return (
        f"{_text(fv.SCRIPT_HEAD)} || {code} || {_text(fv.SCRIPT_TESTS)} || "
        f"array_to_string(list_transform({tests}, lambda t, j: {block}), '')"
    )


def _recorded(a: str, b: str) -> str:
    """Columns of a recorded script run."""
    stdouts = ", ".join(_text(t) for t in STDOUTS)
    stderrs = ", ".join(_text(t) for t in STDERRS)
    return f"""
      case when {a} % 11 between 1 and 4 then 1 else 0 end as returncode,
      [{stdouts}][({a} + {b}) % 9 + 1] as stdout, [{stderrs}][{a} % 11 + 1] as stderr,
      {a} % 11 = 0 as timed_out,
      case when {a} % 11 = 6 then 'no space left - PASS on' end as runner_error"""


def _judge(source: str, name: str) -> str:
    """CTEs that add test_outputs and passed to ``source`` (script and recorded run)."""
    return f"""
  {name}_lines as (
    select *, {_strip('stderr')} as err, list_filter(string_split({_strip('stdout')}, {_NL}),
        lambda x: starts_with(x, 'Test')) as lines from {source}),
  {name}_outputs as (
    select *, case
      when timed_out then ['TIMEOUT']
      when runner_error is not null then ['ERROR: ' || runner_error]
      when returncode <> 0 and len(list_filter(string_split(err, {_NL}),
          lambda x: contains(x, 'AssertionError:'))) > 0
        then ['Test 1: FAIL - Assertion failed: ' || {_strip(
            "regexp_replace(list_filter(string_split(err, chr(10)), "
            "lambda x: contains(x, 'AssertionError:'))[1], '^.*?AssertionError:', '')")}]
      when returncode <> 0 and contains(err, 'AssertionError')
        then case when len(lines) = 0 then ['Test 1: FAIL - Assertion failed'] else lines end
      when returncode <> 0 and err <> ''
        then ['Test 1: FAIL - ' || string_split(err, {_NL})[-1]]
      when returncode <> 0 then ['Test 1: FAIL - Script failed with return code 1']
      when len(lines) = 0 and err = '' and contains(script, 'assert ')
        then ['Test 1: PASS - All assertions passed silently']
      else lines end as test_outputs from {name}_lines),
  {name} as (
    select * replace (
        case when len(test_outputs) = 0 then []::varchar[] else test_outputs end as test_outputs),
      not timed_out and runner_error is null and len(test_outputs) > 0
        and len(list_filter(test_outputs, lambda x: not contains(x, 'PASS'))) = 0 as passed
    from {name}_outputs)"""


def _without_code(source: str, name: str) -> str:
    return f"""
  {name} as (
    select * replace (
        passed and generated_code <> '' as passed,
        case when generated_code = '' then []::varchar[] else test_outputs end as test_outputs),
      case when generated_code = '' then 'No code generated' else '' end as error
    from {source})"""


# --- views -----------------------------------------------------------------------------------

_RAW = f"""
  raw as (
    select l_partkey as problem_id, {_run('l_suppkey')} as run_id,
      l_quantity <= 1 + (l_partkey * 7919) % 50 as passed, l_orderkey, l_linenumber, l_suppkey
    from lineitem)"""

_ATTEMPTS = _RAW + """,
  attempts as (
    select problem_id, run_id, passed from (
      select *, row_number() over (partition by problem_id, run_id
        order by l_orderkey, l_linenumber, l_suppkey, passed) as rn from raw) where rn = 1)"""


def _pass_at(k: int) -> str:
    return (
        f"case when n - c < {k} then 1.0 else 1.0 - coalesce(list_aggregate(list_transform("
        f"range(n - c + 1, n + 1), lambda i: 1.0 - {k}.0::double / i), 'product'), 1.0) end"
    )


def _rates(source: str, name: str, ks: list[int] = fv.PASS_AT) -> str:
    """CTE with n, c and pass@k per problem of ``source``."""
    columns = ", ".join(f'{_pass_at(k)} as "pass@{k}"' for k in ks)
    return f"""
  {name}_counts as (
    select problem_id, count(passed) as n, cast(count_if(passed) as bigint) as c
    from {source} group by problem_id),
  {name} as (select problem_id, n, c, {columns} from {name}_counts)"""


_CLASS = (
    "case when \"pass@1\" >= 0.75 then 'Easy' when \"pass@1\" >= 0.30 then 'Medium' "
    "else 'Hard' end"
)
_CLASSIFIED = f"""{_ATTEMPTS},{_rates('attempts', 'rates')},
  classified as (select *, {_CLASS} as difficulty from rates)"""

_TARGETS = ", ".join(
    f"('{mix}', '{name}', {share}::double)"
    for mix, shares in fv.MIXES.items()
    for name, share in shares.items()
)
_SAMPLES = f"""{_CLASSIFIED},
  targets(dataset, difficulty, share) as (values {_TARGETS}),
  ranked as (
    select *, row_number() over (partition by difficulty
      order by md5(problem_id || ':42'), cast(problem_id as varchar)) as rn,
      count(*) over () as n_all from classified),
  samples as (
    select t.dataset, r.problem_id, r."pass@1", r."pass@5", r."pass@10", r.difficulty
    from ranked r join targets t using (difficulty) where r.rn <= floor(r.n_all::double * t.share))"""

_LINE_CODE = (
    f"case when l_linenumber = 7 and l_suppkey % 5 = 0 then '' else 'def f_' || l_partkey || "
    f"'(x):' || {_NL} || '    return x + ' || l_suppkey || "
    f"case when l_linenumber % 2 = 0 then {_NL} || '    assert x' else '' end end"
)
_EVALUATIONS = f"""
  line_runs as (
    select *, {_script('generated_code', 'test_cases')} as script from (
      select l_partkey as problem_id, {_run('l_suppkey')} as run_id,
        l_orderkey, l_linenumber, l_suppkey, 'Problem ' || l_partkey as problem_statement,
        {_tests('l_partkey', 'l_partkey % 7')} as test_cases, {_LINE_CODE} as generated_code,
        {_recorded('l_orderkey', '(l_suppkey + l_linenumber)')}
      from lineitem)),{_judge('line_runs', 'line_judged')},
  {_without_code('line_judged', 'evaluations').strip()}"""

_BEST = """
  scored as (
    select *, case when passed then 100 else len(list_filter(test_outputs,
      lambda x: contains(x, 'PASS'))) end as score from evaluations),
  best as (
    select * from (select *, row_number() over (partition by problem_id
      order by score desc, run_id, l_orderkey, l_linenumber, l_suppkey) as rn from scored)
    where rn = 1)"""

_PROBLEMS = f"""
  problems as (
    select p_partkey as task_id,
      'Add ' || p_size || ' to the input, as for a ' || p_name as text,
      'def f_' || p_partkey || '(x):' || chr(13) || {_NL} || '    return x + ' || p_size as code,
      {_tests('p_partkey', 'p_size')} as test_list, {_split('p_partkey')} as split
    from part)"""

_WRAPPED = f"""case
        when doc_id % 6 = 0 then 'Here is the code:' || {_NL} || '```python' || {_NL} || text || {_NL}
          || '```' || {_NL} || 'Done.' || case when doc_id % 4 = 0 then {_NL} || '```python' || {_NL}
          || 'def extra():' || {_NL} || '    return ' || doc_id || {_NL} || '```' else '' end
        when doc_id % 6 = 1 then 'Answer:' || {_NL} || '```' || {_NL} || text || {_NL} || '```' || {_NL} || 'Bye'
        when doc_id % 6 = 2 then 'Sure.' || {_NL} || '  def solve(x):' || {_NL} || '    return ' || doc_id
          || {_NL} || {_NL} || chr(9) || text
        when doc_id % 12 = 3 then '```python' || {_NL} || text
        when doc_id % 12 = 9 then '```' || {_NL} || text
        when doc_id % 6 = 4 then '' else ' ' || text || {_NL} end"""
_RESPONSES = f"""
  responses as (
    select doc_id as problem_id, {_run('doc_id')} as run_id, {_split('doc_id')} as split,
      'Question ' || doc_id as prompt, 'Problem ' || doc_id as problem_statement,
      'def ref_' || doc_id || '():' || {_NL} || '    return ' || doc_id as code,
      {_tests('doc_id', 'doc_id % 7')} as test_cases,
      case when doc_id % 17 = 0 then 'timeout' else '' end as error,
      case when doc_id % 17 = 0 or doc_id % 19 = 0 then '' else {_WRAPPED} end as content,
      case when doc_id % 17 <> 0 and doc_id % 13 <> 0 then n_chars end as tokens,
      cast(doc_id as double) as timestamp
    from documents)"""

_CODED = f"""{_RESPONSES},
  blocks as (
    select *, case
      when contains(content, '```python') then list_transform(
        list_filter(string_split(content, '```python')[2:], lambda p: contains(p, '```')),
        lambda p: {_strip("string_split(p, '```')[1]")})
      when contains(content, '```') then list_filter(list_transform(list_filter(
        string_split(content, '```'), lambda p, i: i % 2 = 0), lambda p: {_strip('p')}),
        lambda p: p <> '' and not starts_with(p, 'python'))
      else list_filter([regexp_extract(content, {_text(_FUNCTION)}, 1)], lambda p: p <> '') end as found
    from responses),
  coded as (
    select *, case when len(found) > 0 then array_to_string(found, {_NL} || {_NL})
      else {_strip('content')} end as generated_code from blocks)"""

_ORDER_RUNS = f"""
  order_runs as (
    select o_orderkey as problem_id, {_run('o_orderkey')} as run_id, {_recorded('o_orderkey', 'o_custkey')}
    from orders)"""
_EVALUATED = f"""{_CODED},{_ORDER_RUNS},
  joined as (
    select c.* exclude (error), {_script('c.generated_code', 'c.test_cases')} as script,
      coalesce(o.returncode, 0) as returncode, coalesce(o.stdout, '') as stdout,
      coalesce(o.stderr, '') as stderr, coalesce(o.timed_out, false) as timed_out,
      case when o.problem_id is null then 'no recorded script run' else o.runner_error end
        as runner_error
    from coded c left join order_runs o using (problem_id, run_id)),{_judge('joined', 'doc_judged')},
  {_without_code('doc_judged', 'evaluated').strip()}"""

_TEST_ROWS = f"""
  outcome as (
    select problem_id, l_orderkey, l_linenumber, l_suppkey, problem_statement,
      coalesce(test_cases[i], 'Test case ' || i || ' (no statement)') as test_case_statement,
      test_outputs[i] as line from (
        select *, unnest(range(1, len(test_outputs) + 1)) as i from evaluations)),
  parsed as (
    select *, case when contains(line, ':') then {_strip("array_to_string(string_split(line, ':')[2:], ':')")}
      else line end as rest from outcome),
  test_rows as (
    select problem_id, l_orderkey, l_linenumber, l_suppkey, problem_statement, test_case_statement,
      case when contains(rest, 'PASS') then 'PASS' else 'FAIL' end as test_output,
      case when contains(rest, ' - ') then array_to_string(string_split(rest, ' - ')[2:], ' - ')
        when contains(rest, 'PASS') then 'Passed' else 'Failed' end as reason from parsed)"""

_TRANSCRIPTS = f"""
  transcripts as (
    select conv_id, turn, case
      when role = 'assistant' then 'system' || {_NL} || 'You are helpful' || {_NL} || 'user' || {_NL}
        || 'turn ' || turn || {_NL} || 'assistant' || {_NL} || {_NL} || 'assistant' || {_NL}
        || 'assistant' || {_NL} || text
      when role = 'user' then 'system' || {_NL} || 'You are helpful' || {_NL} || 'user' || {_NL}
        || 'turn ' || turn || {_NL} || 'assistant' || {_NL} || text
      else 'system' || {_NL} || 'You are helpful' || {_NL} || 'user' || {_NL} || 'turn ' || text
      end as transcript from conversations)"""

_TAGGED = f"""
  tagged as (
    select doc_id as problem_id, case doc_id % 5
      when 0 then 'Use <TAG>' || {_NL} || '  x = 1' || {_NL} || text || {_NL} || 'print(x)' || {_NL}
        || '</TAG> and <TAG>y</TAG>'
      when 1 then 'Use <TAG> # start' || {_NL} || text || {_NL} || '# Test cases' || {_NL}
        || 'print(1) # Expected output: 1'
      when 2 then 'Use <TAG>' || {_NL} || 'def f(x):' || {_NL} || '    return x' || {_NL} || text
      when 3 then 'import os' || {_NL} || text || {_NL} || 'print(2)' || {_NL}
        || '  y = 2 # Expected output: 2'
      else 'Use <TAG>' || chr(9) || 'z = 3' || {_NL} || text || {_NL} || '  import re' || {_NL}
        || 'def g(y):' end as answer from documents)"""
_ENDS = _text("|".join(fv.TAG_ENDS))


def _tag_code(corrected: bool) -> str:
    """CTE ``cut``: the text between the tags, before line cleaning."""
    after = "substr(answer, instr(answer, '<TAG>') + 5)"
    if corrected:
        head = f"string_split(body, {_NL})[1]"
        tail = f"array_to_string(string_split(body, {_NL})[2:], {_NL})"
        tail = f"case when contains(body, {_NL}) then {_NL} || {tail} else '' end"
        cut = f"{head} || regexp_split_to_array({tail}, {_ENDS})[1]"
    else:
        cut = f"regexp_split_to_array(body, {_ENDS})[1]"
    return f"""{_TAGGED},
  opened as (
    select *, case when contains(answer, '<TAG>') then {_strip(after)} end as body,
      case when contains(answer, '<TAG>') then {after} end as after from tagged),
  cut as (
    select problem_id, case when body is null then answer
      when contains(after, '</TAG>') then {_strip("string_split(after, '</TAG>')[1]")}
      else {_strip(cut)} end as code from opened)"""


def _kept(line: str) -> str:
    starts = " ".join(f"and not starts_with({line}, {_text(s)})" for s in fv.TAG_DROPPED_STARTS)
    return f"{line} <> '' and not contains({line}, {_text(fv.TAG_DROPPED_TEXT)}) {starts}"


def _round(name: str) -> str:
    return f'round("{name}", 10) as "{name}"'


_RATE_COLUMNS = ", ".join(_round(f"pass@{k}") for k in fv.PASS_AT)
_POSITION = "l_orderkey, l_linenumber, l_suppkey"


def _evaluation_columns(keys: str, source: str) -> str:
    return (
        f"select {keys}, problem_statement, passed, error, array_to_string(test_outputs, {_NL}) "
        f"as test_outputs, generated_code, array_to_string(test_cases, {_NL}) as test_cases "
        f"from {source}"
    )


def _rate_select(key: str, source: str, order: str = "") -> str:
    return (
        f"select {key}, count(passed) as attempts, cast(count_if(passed) as bigint) as passes, "
        f"round(count_if(passed)::double / count(passed), 10) as pass_rate from {source} "
        f"group by {key} {order}"
    )


def _pivot_select() -> str:
    cells = ", ".join(
        f"coalesce(max(case when run_id = '{r:02d}' then cast(passed as varchar) end), 'missing') "
        f"as run_{r:02d}_pass"
        for r in range(1, 13)
    )
    return f"select problem_id, {cells} from attempts group by problem_id"


def _class_rows(source: str) -> str:
    return f"""
  select d.difficulty, cast(coalesce(n, 0) as bigint) as problems,
    round(coalesce(n, 0)::double / (select count(*) from {source}), 10) as share
  from (values ('Easy'), ('Medium'), ('Hard')) d(difficulty)
  left join (select difficulty, count(*) as n from {source} group by 1) using (difficulty)"""


# A missing verdict is none that passed.
_SOME_NULL = """
some_null as (
  select * replace (coalesce(case when l_orderkey % 11 <> 0 then passed end, false) as passed)
  from evaluations)"""


def _stats(by: str, source: str) -> str:
    no_code = "error = 'No code generated'"
    return f"""
  select {by} count(*) as total_problems, cast(count_if(passed) as bigint) as passed,
    cast(count_if(not passed) as bigint) as failed,
    round(count_if(passed)::double / count(*), 10) as pass_rate,
    cast(count_if({no_code}) as bigint) as no_code_generated,
    cast(count_if(not passed and not ({no_code})) as bigint) as test_failures from {source}"""


def _response_stats(by: str) -> str:
    return f"""
  select {by} count(*) as total_problems, cast(count_if(error = '') as bigint) as successful_responses,
    cast(count_if(error <> '') as bigint) as failed_responses,
    round(count_if(error = '')::double / count(*), 10) as success_rate,
    round(coalesce(avg(tokens), 0), 10) as average_tokens,
    cast(coalesce(sum(tokens), 0) as bigint) as total_tokens from responses"""


def _by_split(select: str) -> str:
    return select + " group by grouping sets ((split), ())"


_SPLIT_NAME = "case when grouping(split) = 1 then 'overall' else split end as split,"
_STORED = "select problem_id, split, prompt, timestamp, code, content, error from responses"


_FLAWED = f"""
  lines as (
    select {_run('l_suppkey')} as run_id, l_orderkey, l_partkey, l_quantity,
      '{{"problem_id": ' || case when l_orderkey % 13 = 2 then '"test_' || l_partkey || '"'
        else l_partkey::varchar end || ', "error": "' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey as head
    from lineitem),
  flawed as (
    select *, case
        when l_orderkey % 7 = 3 then 'not JSON'
        when l_orderkey % 11 = 5 then 'not an object'
        when l_orderkey % 13 = 2 then 'id is not a whole number' end as reason,
      case when l_orderkey % 7 = 3 then head
        when l_orderkey % 11 = 5 then '[' || l_orderkey || ']'
        else head || '", "passed": ' || (l_quantity > 25)::varchar || '}}' end as value
    from lines)"""

_TOP_CLASSES = f"""{_CLASSIFIED},
  top_rates as (
    select a.problem_id, count(*) as attempts, cast(count_if(passed) as bigint) as passes,
      round(count_if(passed)::double / count(*), 10) as pass_rate, any_value(difficulty) as difficulty,
      {_split('a.problem_id')} as split
    from attempts a join classified c using (problem_id) group by a.problem_id)"""

_PRESENCE = """
  present as (
    select *, doc_id % 17 in (0, 1) as with_key, doc_id % 17 = 1 as null_key from documents)"""


def _top_rows(source: str, by: str, order: str, n: int) -> str:
    return f"""
  select * exclude (rn), rn::int as place from (
    select *, row_number() over (partition by {by} order by {order}) as rn from {source}) where rn <= {n}"""


def oracle_sql() -> dict[str, str]:
    def sql(ctes: str, select: str) -> str:
        return f"with {ctes.strip()}\n{select.strip()}"

    problem_columns = (
        f"select task_id, split, text, code, array_to_string(test_list, {_NL}) as tests from problems"
    )
    mixed = f"{_SAMPLES},{_EVALUATIONS},{_BEST}"
    code_result = {
        "wrong": "Test {i}: FAIL - Result does not match expected output",
        "boom": "Test {i}: FAIL - boom",
        "fine": "Test {i}: PASS - All Clear",
    }
    per_test = {
        kind: f"array_to_string(list_transform(range(1, task_id % 4 + 1), lambda i: "
        f"replace({_text(text)}, '{{i}}', cast(i as varchar))), {_NL})"
        for kind, text in code_result.items()
    }
    return {
        "pass_at_k_classes": sql(_CLASSIFIED, _class_rows("classified")),
        "pass_at_k": sql(
            f"{_ATTEMPTS},{_rates('attempts', 'rates')}",
            f"select problem_id, n, c, {_RATE_COLUMNS} from rates",
        ),
        "pass_at_k_strict": sql(
            f"{_ATTEMPTS},{_rates('attempts', 'rates', [1, 5, 10, 12])}",
            "select problem_id, n, c, " + ", ".join(
                f'case when n >= {k} then round("pass@{k}", 10) end as "pass@{k}"'
                for k in (1, 5, 10, 12)
            ) + " from rates",
        ),
        "pass_at_k_all_attempts": sql(
            f"{_RAW},{_rates('raw', 'rates')}",
            f"select problem_id, n, c, {_RATE_COLUMNS} from rates",
        ),
        "difficulty_classes": sql(
            _CLASSIFIED, f"select problem_id, {_round('pass@1')}, difficulty from classified"
        ),
        "mean_pass_at_k": sql(
            _CLASSIFIED,
            "select difficulty, " + ", ".join(
                f'round(avg("pass@{k}"), 10) as "mean_pass@{k}"' for k in fv.PASS_AT
            ) + " from classified group by difficulty",
        ),
        "attempt_projection": """
            select l_partkey as problem_id, cast(l_suppkey % 12 + 1 as varchar) as run_id,
              case when l_returnflag = 'R' then false else l_quantity > 25 end as passed
            from lineitem""",
        "attempt_id_check": """
            select cast(l_suppkey % 12 + 1 as varchar) as run_id,
              cast(count_if(l_linenumber <> 7) as bigint) as kept,
              cast(count_if(l_linenumber = 7) as bigint) as set_aside,
              max(case when l_linenumber = 7 then 'test_' else '' end || l_partkey) as last_raw_id
            from lineitem group by 1""",
        "attempts_in_order": sql(
            _ATTEMPTS, "select problem_id, run_id, passed from attempts order by run_id, problem_id"
        ),
        "duplicate_attempts": sql(
            _RAW,
            'select problem_id, run_id, count(*) as "rows" from raw group by 1, 2 having count(*) > 1',
        ),
        "attempts_of_one_problem": sql(_RAW, "select * from raw where problem_id = 101"),
        "pass_at_k_above_id": sql(
            f"{_ATTEMPTS},{_rates('attempts', 'rates')}",
            f"select problem_id, n, c, {_RATE_COLUMNS} from rates where problem_id > 600",
        ),
        "pass_at_k_listed_ids": sql(
            f"{_ATTEMPTS},{_rates('attempts', 'rates')}",
            f"select problem_id, n, c, {_RATE_COLUMNS} from rates "
            "where problem_id in (select doc_id from labels where quality = 1)",
        ),
        "attempts_of_short_list": sql(
            _RAW,
            "select problem_id, count(passed) as attempts, cast(count_if(passed) as bigint) as passes, "
            "round(count_if(passed)::double / count(passed), 10) as pass_rate from raw "
            "where problem_id in (601, 602, 603, 607) group by 1",
        ),
        "latest_run_rows": """
            select 'results_' || strftime(ts, '%Y%m%d') as run_ts, event_id, user_id,
              round(value, 10) as value from events
            where cast(ts as date) = (select max(cast(ts as date)) from events)""",
        "overall_rate": sql(
            _ATTEMPTS,
            "select count(*) as attempts, cast(count_if(passed) as bigint) as passes, "
            "cast(count_if(not passed) as bigint) as failures, "
            "round(count_if(passed)::double / count(*), 10) as pass_rate from attempts",
        ),
        "rate_by_run": sql(_ATTEMPTS, _rate_select("run_id", "attempts", "order by run_id")),
        "rate_by_problem": sql(_ATTEMPTS, _rate_select("problem_id", "attempts")),
        "top_by_count": sql(
            _RAW,
            _rate_select("problem_id", "raw", "order by count(passed) desc, problem_id limit 10"),
        ),
        "top_by_rate": sql(
            _ATTEMPTS,
            "select problem_id, round(avg(cast(passed as int)), 10) as pass_rate from attempts "
            "group by 1 order by 2 desc, 1 limit 10",
        ),
        "bottom_by_rate": sql(
            _ATTEMPTS,
            "select problem_id, round(avg(cast(passed as int)), 10) as pass_rate from attempts "
            "group by 1 order by 2, 1 limit 10",
        ),
        "run_coverage_rate": sql(
            _ATTEMPTS,
            "select run_id, cast(count_if(passed) as bigint) as passes, "
            "(select count(distinct problem_id) from attempts) as problems, "
            "round(count_if(passed)::double / (select count(distinct problem_id) from attempts), 10) "
            "as coverage_rate from attempts group by 1",
        ),
        "pivot_runs": sql(_ATTEMPTS, _pivot_select()),
        "pivot_checked": sql(_ATTEMPTS, _pivot_select()),
        "unpivot_runs": sql(_ATTEMPTS, "select run_id, problem_id, passed from attempts"),
        "pass_at_k_from_pivot_csv": sql(
            f"{_ATTEMPTS},{_rates('attempts', 'rates')}",
            f"select problem_id, n, c, {_RATE_COLUMNS} from rates",
        ),
        "stratified_mixes": sql(
            _SAMPLES, f"select dataset, problem_id, {_RATE_COLUMNS}, difficulty from samples"
        ),
        "mix_summary": sql(
            _SAMPLES,
            """select dataset as "Dataset", count(*) as "Total_Samples", """
            + ", ".join(
                f"""cast(count_if(difficulty = '{c}') as bigint) as "{c}_Count", """
                f"""round(count_if(difficulty = '{c}')::double / count(*), 10) as "{c}_Pct" """
                for c in fv.CLASSES
            )
            + ", "
            + ", ".join(f'round(avg("pass@{k}"), 10) as "Avg_Pass@{k}"' for k in fv.PASS_AT)
            + " from samples group by dataset",
        ),
        "shuffled_mix": sql(
            _SAMPLES,
            "select dataset, problem_id, difficulty, md5(problem_id || ':43') || ':' || problem_id "
            "as shuffle_key from samples order by shuffle_key",
        ),
        "sample_csv": sql(
            _SAMPLES,
            f"select dataset, problem_id, {_RATE_COLUMNS}, difficulty from samples",
        ),
        "passed_test_count": sql(
            _EVALUATIONS,
            f"select problem_id, {_POSITION}, cast(len(list_filter(test_outputs, "
            "lambda x: contains(x, 'PASS'))) as integer) as passed_tests from evaluations",
        ),
        "best_attempt": sql(
            f"{_EVALUATIONS},{_BEST}",
            f"select problem_id, run_id, {_POSITION}, cast(score as integer) as score from best",
        ),
        "sampled_best_attempts": sql(
            mixed,
            f"select dataset, problem_id, run_id, {_POSITION}, cast(score as integer) as score "
            "from samples join best using (problem_id)",
        ),
        "reference_code": """
            select problem_id, code from (
              select l_partkey as problem_id,
                'v-' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey as code,
                row_number() over (partition by l_partkey
                  order by l_orderkey desc, l_linenumber desc, l_suppkey desc) as rn
              from lineitem) where rn = 1""",
        "train_rows": sql(
            f"{mixed},{_RESPONSES}",
            f"select s.dataset, problem_id, "
            f"{_instruction('b.problem_statement', 'problem_id', 'b.test_cases')} as instruction, "
            "r.code as output from samples s join best b using (problem_id) "
            "join responses r using (problem_id)",
        ),
        "train_rows_own_code": sql(
            mixed,
            "select s.dataset, problem_id, b.problem_statement as instruction, "
            "b.generated_code as output from samples s join best b using (problem_id)",
        ),
        "train_rows_missing": """
            select o_orderkey as problem_id,
              case when o_orderkey not in (select l_partkey from lineitem) then 'no results'
                else 'no reference code' end as reason
            from orders where o_orderkey not in (select l_partkey from lineitem)
              or o_orderkey not in (select doc_id from documents)""",
        "train_rows_jsonl": sql(
            f"{mixed},{_RESPONSES}",
            f"select s.dataset, {_instruction('b.problem_statement', 'problem_id', 'b.test_cases')} as instruction, "
            "r.code as output from samples s join best b using (problem_id) "
            "join responses r using (problem_id)",
        ),
        "prompts": sql(
            _PROBLEMS, f"select task_id, {_prompt('text', 'task_id', 'test_list')} as prompt from problems"
        ),
        "instructions": sql(
            _PROBLEMS,
            f"select task_id, {_instruction('text', 'task_id', 'test_list')} as instruction from problems",
        ),
        "response_contents": sql(_RESPONSES, "select problem_id, content from responses"),
        "generated_code": sql(_CODED, "select problem_id, generated_code from coded"),
        "tagged_code": sql(
            _tag_code(corrected=False),
            f"select problem_id, array_to_string(list_filter(list_transform(string_split(code, {_NL}), "
            f"lambda x: {_strip('x')}), lambda x: {_kept('x')}), {_NL}) as code from cut",
        ),
        "tagged_code_corrected": sql(
            _tag_code(corrected=True),
            f"select problem_id, array_to_string(list_filter(string_split(code, {_NL}), "
            f"lambda x: {_kept(_strip('x'))}), {_NL}) as code from cut",
        ),
        "last_assistant_parts": sql(
            _TRANSCRIPTS,
            f"select conv_id, turn, case when contains(transcript, {_NL} || 'assistant' || {_NL}) "
            f"then string_split(transcript, {_NL} || 'assistant' || {_NL})[-1] else '' end as answer "
            "from transcripts",
        ),
        "test_scripts": sql(
            _PROBLEMS, f"select task_id, {_script('code', 'test_list')} as script from problems"
        ),
        "verdicts": sql(
            f"{_ORDER_RUNS}, scripted as (select *, case when problem_id % 2 = 0 then 'assert x' "
            f"else 'x' end as script from order_runs),{_judge('scripted', 'judged')}",
            "select problem_id, passed, cast(len(test_outputs) as integer) as outputs, "
            f"array_to_string(test_outputs, {_NL}) as test_outputs from judged",
        ),
        "verdicts_printed_lines_only": sql(
            f"{_ORDER_RUNS}, printed as (select *, case when timed_out then ['TIMEOUT'] "
            "when runner_error is not null then ['ERROR: ' || runner_error] "
            f"else list_filter(string_split({_strip('stdout')}, {_NL}), "
            "lambda x: starts_with(x, 'Test')) end as lines from order_runs)",
            "select problem_id, not timed_out and runner_error is null and len(list_filter(lines, "
            "lambda x: not contains(x, 'PASS'))) = 0 as passed, cast(len(lines) as integer) as outputs, "
            f"array_to_string(lines, {_NL}) as test_outputs from printed",
        ),
        "evaluate": sql(_EVALUATED, _evaluation_columns("problem_id, run_id", "evaluated")),
        "explode_tests": sql(f"{_EVALUATIONS},{_TEST_ROWS}", "select * from test_rows"),
        "test_row_summary": sql(
            f"{_EVALUATIONS},{_TEST_ROWS}",
            "select count(*) as total_rows, count(distinct problem_id) as unique_problems, "
            "cast(count_if(test_output = 'PASS') as bigint) as pass_rows, "
            "cast(count_if(test_output = 'FAIL') as bigint) as fail_rows from test_rows",
        ),
        "evaluation_stats": sql(_EVALUATIONS, _stats("", "evaluations")),
        "evaluation_stats_by_split": sql(_EVALUATED, _by_split(_stats(_SPLIT_NAME, "evaluated"))),
        "passed_ids": sql(_EVALUATIONS, "select run_id, problem_id from evaluations where passed"),
        "failed_ids": sql(_EVALUATIONS, "select run_id, problem_id from evaluations where not passed"),
        "failed_preview": sql(
            _EVALUATIONS,
            f"select problem_id, {_POSITION}, case when error <> '' then error else "
            f"array_to_string(test_outputs, {_NL}) end as details from evaluations where not passed "
            f"order by problem_id, {_POSITION} limit 3",
        ),
        "script_execution": sql(
            _PROBLEMS,
            f"""
            select task_id as problem_id,
              task_id % 4 > 0 and task_id % 5 <> 0 and task_id % 7 <> 0 and task_id % 11 <> 0 as passed,
              case when task_id % 5 <> 0 and task_id % 7 <> 0 and task_id % 11 = 0 then 1 else 0 end
                as returncode,
              case when task_id % 5 = 0 then {per_test['wrong']}
                when task_id % 7 = 0 then {per_test['boom']}
                when task_id % 11 = 0 then 'Test 1: FAIL - SyntaxError: invalid syntax'
                else {per_test['fine']} end as test_outputs from problems""",
        ),
        "response_stats": sql(_RESPONSES, _response_stats("")),
        "response_stats_by_split": sql(_RESPONSES, _by_split(_response_stats(_SPLIT_NAME))),
        "response_records": sql(
            f"{_PROBLEMS},{_RESPONSES}",
            "select case when p.task_id % 10 = 7 then 'unknown_' else '' end || p.task_id as problem_id, "
            f"{_prompt('p.text', 'p.task_id', 'p.test_list')} as prompt, r.timestamp, p.code, r.content "
            "from problems p join responses r on p.task_id = r.problem_id",
        ),
        "run_metadata": sql(
            _PROBLEMS,
            """
            select c_custkey as run_number, s.split, c_nationkey % 5 = 0 as demo_mode,
              case when c_custkey % 3 > 0 then c_custkey % 300 else 0 end as max_problems,
              case when c_custkey % 2 = 0 then 'served' else '' end as model_name,
              case when c_custkey % 2 = 1 then 'local' else '' end as model_path,
              coalesce(loaded, 0) as total_problems_loaded,
              cast(case when c_nationkey % 5 = 0 then 4
                when c_custkey % 3 > 0 and c_custkey % 300 > 0
                  then least(coalesce(loaded, 0), c_custkey % 300)
                else coalesce(loaded, 0) end as bigint) as problems_to_process
            from customer
            join (values (0, 'prompt'), (1, 'test'), (2, 'validation'), (3, 'train')) s(i, split)
              on s.i = c_custkey % 4
            left join (select split, count(*) as loaded from problems group by 1) l
              on l.split = s.split""",
        ),
        "ledger_summary": """
            select count(*) as total_runs, cast(count_if(event_type <> 'error') as bigint) as successful_runs,
              cast(count_if(event_type = 'error') as bigint) as failed_runs,
              round(count_if(event_type <> 'error')::double / count(*), 10) as success_rate from events""",
        "first_problems": sql(_PROBLEMS, "select task_id, text from problems order by task_id limit 50"),
        "demo_problems": sql(_PROBLEMS, "select task_id, text from problems order by task_id limit 4"),
        "problem_preview": sql(
            _PROBLEMS,
            "select task_id, " + ", ".join(
                f"case when length({c}) > 100 then left({c}, 100) || '...' else {c} end as {name}"
                for c, name in (
                    ("text", "text"), ("code", "code"),
                    (f"({_prompt('text', 'task_id', 'test_list')})", "prompt"),
                )
            ) + " from problems order by task_id limit 3",
        ),
        "response_preview": sql(
            _RESPONSES,
            "select problem_id, left(prompt, 200) || '...' as prompt, "
            "left(case when error <> '' then error else content end, 200) || '...' as reply "
            "from responses order by problem_id limit 3",
        ),
        "splits_of_full_run": sql(
            _PROBLEMS, "select task_id, split from problems where split <> 'prompt'"
        ),
        "splits_of_fine_tuned_run": sql(
            _PROBLEMS, "select task_id, split from problems where split in ('test', 'validation')"
        ),
        "stored_problems": sql(_PROBLEMS, f"{problem_columns} where split = 'test'"),
        "stored_problems_other_split": sql(_PROBLEMS, f"{problem_columns} where split = 'train'"),
        "stored_responses": sql(_RESPONSES, f"{_STORED} where split <> 'prompt'"),
        "stored_responses_one_file": sql(_RESPONSES, f"{_STORED} where split = 'validation'"),
        "stored_run_attempts": sql(_EVALUATIONS, "select run_id, problem_id, passed from evaluations"),
        "stored_run_evaluations": sql(
            _EVALUATIONS, _evaluation_columns("problem_id, run_id", "evaluations")
        ),
        "stored_lines_well_formed": sql(
            _RESPONSES, "select problem_id, prompt, timestamp from responses where problem_id % 7 <> 0"
        ),
        "streamed_progress": sql(_RESPONSES, _response_stats("run_id,") + " group by run_id"),
        "streamed_progress_of_cut_lines": sql(
            _RESPONSES, _response_stats("run_id,") + " where problem_id % 7 <> 0 group by run_id"
        ),
        "stored_array_attempts": sql(_EVALUATIONS, "select run_id, problem_id, passed from evaluations"),
        "pass_at_k_csv": sql(
            f"{_ATTEMPTS},{_rates('attempts', 'rates')}", f"select problem_id, {_RATE_COLUMNS} from rates"
        ),
        "all_ids": sql(_EVALUATIONS, "select run_id, problem_id from evaluations"),
        "evaluation_stats_null_verdicts": sql(f"{_EVALUATIONS},{_SOME_NULL}", _stats("", "some_null")),
        "failed_ids_null_verdicts": sql(
            f"{_EVALUATIONS},{_SOME_NULL}", "select run_id, problem_id from some_null where not passed"
        ),
        "best_attempt_by_file_order": sql(
            f"{_EVALUATIONS},{_BEST}", "select problem_id, run_id, score::int as score, generated_code from best"
        ),
        "reference_code_by_file_order": """
            select problem_id, code from (
              select l_partkey as problem_id,
                'v-' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey as code,
                row_number() over (partition by l_partkey
                  order by l_orderkey desc, l_linenumber desc, l_suppkey desc) as rn
              from lineitem) where rn = 1""",
        "rejected_records": sql(
            _FLAWED, "select run_id, reason, value as rejected from flawed where reason is not null"
        ),
        "kept_records": sql(
            _FLAWED,
            """select run_id, count(*) as attempts, cast(count_if(l_quantity > 25) as bigint) as passes,
              round(count_if(l_quantity > 25)::double / count(*), 10) as pass_rate,
              (select count(*) from flawed where reason is null) as all_kept,
              (select count(*) from flawed where reason is not null) as all_set_aside
            from flawed where reason is null group by run_id""",
        ),
        "skipped_runs": sql(
            _RAW,
            """select lpad(r::varchar, 2, '0') as run_id, case
                when r = 3 then 'no evaluations file'
                when lpad(r::varchar, 2, '0') not in (select run_id from raw) then 'no run folder'
                else 'no readable record' end as reason
            from range(1, 14) t(r)
            where r in (3, 7) or lpad(r::varchar, 2, '0') not in (select run_id from raw)""",
        ),
        "quarantined_attempts": """
            select cast(l_suppkey % 12 + 1 as varchar) as run_id,
              cast(count_if(l_linenumber <> 7) as bigint) as kept,
              cast(sum(case when l_linenumber <> 7 then l_partkey end) as bigint) as id_sum,
              cast(count_if(l_linenumber = 7) as bigint) as set_aside,
              coalesce(max(case when l_linenumber = 7 then 'test_' || l_partkey end), '') as last_raw_id,
              case when count_if(l_linenumber = 7) > 0 then 'id is not a whole number' else '' end as reason,
              (select count(*) from lineitem where l_linenumber <> 7) as all_kept,
              (select count(*) from lineitem where l_linenumber = 7) as all_set_aside
            from lineitem group by 1 having count_if(l_linenumber <> 7) > 0""",
        "hardest_by_split_and_class": sql(
            _TOP_CLASSES, _top_rows("top_rates", "split, difficulty", "pass_rate, problem_id", 10)
        ),
        "easiest_by_class": sql(
            _TOP_CLASSES, _top_rows("top_rates", "difficulty", "pass_rate desc, problem_id", 25)
        ),
        "most_attempted_by_split": sql(
            f"""{_RAW},
  raw_rates as (
    select problem_id, count(*) as attempts, cast(count_if(passed) as bigint) as passes,
      round(count_if(passed)::double / count(*), 10) as pass_rate, {_split('problem_id')} as split
    from raw group by problem_id)""",
            _top_rows("raw_rates", "split", "attempts desc, problem_id", 10),
        ),
        "passed_id_arrays": sql(
            _EVALUATIONS,
            """select run_id, string_agg(problem_id::varchar, ',' order by problem_id) as problem_ids
            from evaluations where passed group by run_id""",
        ),
        "distinct_problems_from_sketches": sql(
            f"{_EVALUATIONS},{_TEST_ROWS}",
            """select e.run_id, cast(sum(len(test_outputs)) as bigint) as "rows",
              count(distinct problem_id) as unique_problems, true as near
            from evaluations e where len(test_outputs) > 0 group by e.run_id
            union all
            select 'overall', cast(sum(len(test_outputs)) as bigint), count(distinct problem_id), true
            from evaluations where len(test_outputs) > 0""",
        ),
        "run_coverage_from_sketches": sql(
            _ATTEMPTS,
            """select run_id, cast(count_if(passed) as bigint) as passes, true as near
            from attempts group by run_id""",
        ),
        "response_stats_by_key_presence": sql(
            f"""{_PRESENCE.strip()},
  keyed as (
    select {_split('doc_id')} as split, with_key, null_key,
      case when doc_id % 17 <> 0 and doc_id % 13 <> 0 then n_chars end as tokens from present)""",
            f"""select {_SPLIT_NAME} count(*) as total_problems,
              cast(count_if(not with_key) as bigint) as successful_responses,
              cast(count_if(with_key) as bigint) as failed_responses,
              cast(count_if(null_key) as bigint) as null_errors,
              round(count_if(not with_key)::double / count(*), 10) as success_rate,
              round(coalesce(avg(tokens), 0), 10) as average_tokens,
              cast(coalesce(sum(tokens), 0) as bigint) as total_tokens
            from keyed group by grouping sets ((split), ())""",
        ),
        "contents_by_key_presence": sql(
            _RESPONSES,
            "select problem_id, case when problem_id % 17 in (0, 1) then '' else content end as content from responses",
        ),
        "streamed_progress_with_repeats": sql(
            _RESPONSES, _response_stats("run_id,") + " group by run_id"
        ),
        "response_of_unknown_id": """
            select case when p_partkey % 10 = 7 then 'unknown_' || p_partkey else p_partkey::varchar end as problem_id,
              doc_id::double as "timestamp"
            from part join documents on p_partkey = doc_id
            where p_partkey = 17 or (p_partkey % 10 <> 7 and p_partkey > 90)""",
        "missing_response_splits": sql(
            _RESPONSES,
            """select split from (values ('test'), ('train'), ('validation')) t(split)
            where split = 'validation' or split not in (select split from responses)""",
        ),
    }
