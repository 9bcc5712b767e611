"""Running test scripts in batches, with a runner the caller supplies.

This executes untrusted code. Nothing in the library calls it by itself.
"""

from __future__ import annotations

import locale
import struct
import subprocess
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv

# (script, seconds) -> (returncode, stdout, stderr); raises TimeoutError when time is up.
Runner = Callable[[str, float], tuple[int, str, str]]

_RESULT = (
    "returncode int, stdout string, stderr string, timed_out boolean, runner_error string"
)


# Run by an interpreter that stays: it forks itself for every script it reads and sends back how the fork
# ended. A request is seconds and a length, then the script; an answer is whether time was up, the
# return code and two lengths, then both outputs. No name of it stands in the script's ``__main__``.
_SERVER = """
import atexit, gc, io, os, select, signal, struct, sys, time
# What the first text to be compiled, printed or reported costs is spent here and not in every fork.
texts, sys.stderr = (sys.stdout, sys.stderr), io.StringIO()
sys.stdout = io.StringIO()
for source in (
    "import sys\\ndef f(x, *y):\\n    return [k + 1 for k in y] or x + 1\\nclass A:\\n    pass\\n"
    "try:\\n    r = f(1) == 2\\n    if r:\\n        print(f'a {r}: b')\\n    else:\\n        print('c')\\n"
    "    raise ValueError('d')\\nexcept Exception as e:\\n    print(f'e {e}')\\nassert f(2) == 1, 'f'",
    "def f(:",
):
    try:
        exec(compile(source, "<stdin>", "exec", dont_inherit=True), {})
    except Exception:
        sys.__excepthook__(*sys.exc_info())
(sys.stdout, sys.stderr), source = texts, None
if "linecache" in sys.modules:
    sys.modules["linecache"].clearcache()
gc.collect(), gc.freeze()
def read(size):
    data = b""
    while len(data) < size:
        more = os.read(0, size - len(data))
        if not more:
            os._exit(0)
        data += more
    return data
def write(data):
    while data:
        data = data[os.write(1, data):]
while True:
    seconds, size = struct.unpack("<dq", read(16))
    source = read(size)
    (out, out_end), (err, err_end) = os.pipe(), os.pipe()
    pid = os.fork()
    if not pid:
        break
    os.close(out_end), os.close(err_end)
    until, texts, poll = time.monotonic() + seconds, {out: [], err: []}, select.poll()
    poll.register(out, select.POLLIN), poll.register(err, select.POLLIN)
    open_ends, late, ended = {out, err}, False, None
    while ended is None:
        left = until - time.monotonic()
        if left <= 0:
            os.kill(pid, signal.SIGKILL)
            late, ended = True, os.waitpid(pid, 0)[1]
        elif open_ends:
            for end, _ in poll.poll(left * 1000 + 1):
                data = os.read(end, 1 << 16)
                texts[end].append(data)
                if not data:
                    open_ends.remove(end), poll.unregister(end)
        else:
            # Both outputs are closed: it is about to end, or goes on without them.
            done, status = os.waitpid(pid, os.WNOHANG)
            if done:
                ended = status
            else:
                time.sleep(0.0002)
    os.close(out), os.close(err)
    one, two = b"".join(texts[out]), b"".join(texts[err])
    write(struct.pack("<?iqq", late, os.waitstatus_to_exitcode(ended), len(one), len(two)) + one + two)
null = os.open(os.devnull, os.O_RDONLY)
os.dup2(null, 0), os.dup2(out_end, 1), os.dup2(err_end, 2)
for end in {null, out, out_end, err, err_end}:
    os.close(end)
sys.argv = ["-"]
main = sys.modules["__main__"].__dict__
main["__file__"], main["__cached__"] = "<stdin>", None
def shown(kind, error, trace):
    # The first frames are those of this text and of what started it.
    while trace and trace.tb_frame.f_code.co_filename == "<string>":
        trace = trace.tb_next
    sys.__excepthook__(kind, error.with_traceback(trace), trace)
sys.excepthook, code = shown, 0
try:
    exec(compile(source, "<stdin>", "exec", dont_inherit=True), main)
except Exception:
    code = 1
    sys.excepthook(*sys.exc_info())
# What an interpreter does when it ends, but for taking itself apart, which costs most of a fork.
if "threading" in sys.modules:
    sys.modules["threading"]._shutdown()
atexit._run_exitfuncs()
main.clear()
gc.collect()
try:
    for text in (sys.stdout, sys.stderr, sys.__stdout__, sys.__stderr__):
        text.flush()
except BaseException:
    sys.exit(code)
os._exit(code)
"""


def python_runner(options: tuple[str, ...] = ()) -> Runner:
    """A runner that gives every script an interpreter that has run nothing before.

    An interpreter is started once a task and forks itself for each script, so a script costs a fork
    and not a start. What a script does to its interpreter ends with its fork; only the seed of text hashes
    is the same for the scripts of a task, and the modules that show an error are loaded already, since
    what is first done in a fork is done anew in every one. Standard input is empty. An interpreter that is
    gone is an error of the script that was running, and the next script gets a new one. It ends with its task.

    ``options`` go to the interpreter: ``-I -S`` keeps the environment and installed packages
    out. The runner is a closure, so executors need not have this package installed.
    """
    program = f"exec({_SERVER!r}, {{}})"
    head = "<?iqq"

    class Held(list):
        """The interpreter, if there is one; none of it travels with the runner."""

        def __reduce__(self) -> tuple:
            return Held, ()

    held = Held()

    def answer(server: subprocess.Popen, size: int) -> bytes:
        data = server.stdout.read(size)
        if len(data) < size:
            raise OSError("the interpreter is gone")
        return data

    def run(script: str | None, seconds: float) -> tuple[int, str, str]:
        encoding = locale.getencoding() if not sys.flags.utf8_mode else "utf-8"
        source = (script or "").encode(encoding)
        if not held:
            held.append(subprocess.Popen(
                [sys.executable, *options, "-c", program],
                stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL,
            ))
        server = held[0]
        try:
            server.stdin.write(struct.pack("<dq", seconds, len(source)) + source)
            server.stdin.flush()
            late, code, *sizes = struct.unpack(head, answer(server, struct.calcsize(head)))
            texts = [answer(server, size) for size in sizes]
        except OSError:
            held.clear()
            server.kill()
            server.wait()
            raise
        if late:
            raise TimeoutError(f"timed out after {seconds} seconds")
        out, err = (t.decode(encoding).replace("\r\n", "\n").replace("\r", "\n") for t in texts)
        return code, out, err

    return run


def run_scripts(
    scripts: DataFrame,
    runner: Runner,
    keys: list[str] = ["problem_id", "run_id"],
    seconds: float = fv.RUN_SECONDS,
    partitions: int | None = None,
) -> DataFrame:
    """How each row's ``script`` ended. No failure of a script or runner fails the job.

    Rows are spread over a fixed number of tasks first, because a script costs time and not
    bytes; left to itself Spark would merge small partitions and run their scripts one after
    another. ``partitions`` defaults to the session's shuffle partitions. Executors that are
    lost run their scripts again, so store the result before using it twice.
    """
    narrow = scripts.select(*keys, "script")
    count = partitions or int(scripts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The script's hash is part of the key, so one problem's many scripts reach all tasks.
    spread = narrow.repartition(count, *keys, F.xxhash64("script"))
    fields = ", ".join(f"{k} {narrow.schema[k].dataType.simpleString()}" for k in keys)

    def outcome(script: str) -> tuple:
        try:
            return (*runner(script, seconds), False, None)
        except TimeoutError:
            return (None, None, None, True, None)
        except Exception as error:  # noqa: BLE001 - any runner failure is a result here
            return (None, None, None, False, str(error))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["returncode", "stdout", "stderr", "timed_out", "runner_error"]
        for batch in batches:
            ended = pd.DataFrame([outcome(s) for s in batch["script"]], columns=names)
            ended["returncode"] = ended["returncode"].astype("Int32")
            yield pd.concat([batch[keys].reset_index(drop=True), ended], axis=1)

    return spread.mapInPandas(run, f"{fields}, {_RESULT}")
