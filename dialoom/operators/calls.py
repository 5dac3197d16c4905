"""Calls of services from tasks: several at once inside a task, under one limit for all tasks, with retries."""

from __future__ import annotations

import hmac
import secrets
import socket
import socketserver
import struct
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .runs import RetryPolicy

#: Calls that one task has open at most, whatever the limit for all.
THREADS = 64
WINDOW = 60.0


class Window:
    """So many starts in any 60 seconds: gives each one its time."""

    def __init__(self, most: int, clock: Callable[[], float] = time.monotonic):
        self.most, self.clock = most, clock
        self.starts: deque[float] = deque()
        self.lock = threading.Lock()

    def wait(self) -> float:
        """Seconds until the call that asks may begin. Its place is taken."""
        with self.lock:
            now = self.clock()
            at = max(now, self.starts[0] + WINDOW) if len(self.starts) >= self.most else now
            self.starts.append(at)
            if len(self.starts) > self.most:
                self.starts.popleft()
            return at - now


class Permits(socketserver.BaseRequestHandler):
    """One connection is one call: it names its limit, is told how long to wait, and is closed when the call is over, or its task lost."""

    def handle(self) -> None:
        service: Service = self.server.service
        said = self.request.recv(64, socket.MSG_WAITALL)
        if len(said) < 64 or not hmac.compare_digest(said[:32].decode("ascii", "replace"), service.secret):
            return
        window, places = service.limit_of(*struct.unpack(">QQ", said[32:48]))
        if places and not self.taken(places):
            return
        try:
            self.request.sendall(struct.pack(">d", window.wait() if window else 0.0))
            self.request.recv(1)  # until the other side closes
        except OSError:
            pass
        finally:
            if places:
                places.release()

    def taken(self, places: threading.Semaphore) -> bool:
        """A free place; none is kept for a task that went away while it waited."""
        self.request.settimeout(0.0)
        while not places.acquire(timeout=1.0):
            try:
                if not self.request.recv(1, socket.MSG_PEEK):
                    return False
            except BlockingIOError:
                pass
        self.request.settimeout(None)
        return True


class Service:
    """The limits of a driver, by (calls in a minute, calls at once): a thread of the driver that tasks ask before each call."""

    def __init__(self):
        self.secret = secrets.token_hex(16)
        self.limits: dict[tuple[int, int], tuple[Window | None, threading.Semaphore | None]] = {}
        self.lock = threading.Lock()

        class Server(socketserver.ThreadingTCPServer):
            daemon_threads, allow_reuse_address, request_queue_size = True, True, 256

        self.server = Server(("", 0), Permits)
        self.server.service = self
        self.port = self.server.server_address[1]
        threading.Thread(target=self.server.serve_forever, daemon=True, name="call-limits").start()

    def limit_of(self, per_minute: int, at_once: int) -> tuple[Window | None, threading.Semaphore | None]:
        with self.lock:
            key = (per_minute, at_once)
            if key not in self.limits:
                self.limits[key] = (Window(per_minute) if per_minute else None, threading.Semaphore(at_once) if at_once else None)
            return self.limits[key]


_services: list[Service] = []


@dataclass(frozen=True)
class Limit:
    """How a task asks for a call: where the driver's service is. Without limits nobody is asked."""

    per_minute: int = 0
    at_once: int = 0
    host: str = ""
    port: int = 0
    secret: str = ""

    def enter(self) -> tuple[socket.socket | None, float]:
        """Wait for a place and for the time; gives what to close after the call, and the seconds waited for the rate."""
        if not self.port:
            return None, 0.0
        held = socket.create_connection((self.host, self.port), timeout=60)
        held.settimeout(None)
        held.sendall(self.secret.encode("ascii") + struct.pack(">QQ", self.per_minute, self.at_once) + bytes(16))
        said = held.recv(8, socket.MSG_WAITALL)
        if len(said) < 8:
            held.close()
            raise ConnectionError("the driver gave no permit")
        seconds = struct.unpack(">d", said)[0]
        if seconds > 0.01:
            time.sleep(seconds)
        return held, seconds if seconds > 0.01 else 0.0


def shared_limit(spark: SparkSession, per_minute: int = 0, at_once: int = 0) -> Limit:
    """One limit for all tasks of this driver that ask for the same numbers; it lives as long as the driver, so plans may run any time."""
    if per_minute <= 0 and at_once <= 0:
        return Limit()
    if not _services:
        _services.append(Service())
    service = _services[0]
    return Limit(max(0, per_minute), max(0, at_once), spark.conf.get("spark.driver.host", "127.0.0.1"), service.port, service.secret)


@dataclass(frozen=True)
class Reply:
    value: object
    attempts: int
    error: str
    waits: int = 0
    seconds: float = 0.0


def replies(values: list, call: Callable[[object], object], policy: RetryPolicy, limit: Limit) -> Iterator[Reply]:
    """The reply to each value, in their order. As many calls are open at once as the limit lets, but no more than THREADS; without one, one after the other."""

    def one(value: object) -> Reply:
        waits, seconds = 0, 0.0

        def operation() -> object:
            nonlocal waits, seconds
            held, waited = limit.enter()
            waits, seconds = waits + (waited > 0), seconds + waited
            try:
                return call(value)
            finally:
                if held is not None:
                    held.close()

        done, attempts, error = policy.call(operation)
        return Reply(done, attempts, error, waits, seconds)

    threads = min(THREADS, limit.at_once) if limit.at_once else 1
    if threads <= 1 or len(values) <= 1:
        yield from map(one, values)
        return
    with ThreadPoolExecutor(threads) as pool:
        yield from pool.map(one, values)


def spread(spark: SparkSession, limit: Limit) -> int:
    """Partitions that calls go to: enough for the cores, no more than may call at once; 0 where nothing is asked for."""
    return min(limit.at_once, max(1, spark.sparkContext.defaultParallelism)) if limit.at_once else 0
