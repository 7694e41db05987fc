"""A read-only file server with byte ranges, on the driver: what remote reading is tried against (SNK-15)."""

from __future__ import annotations

import http.server
import os
import re
import threading
from functools import partial
from urllib.parse import quote

from pyspark.sql import SparkSession

_servers: dict[tuple[str, str], str] = {}


class Ranges(http.server.SimpleHTTPRequestHandler):
    """Serves one range of a file where a request asks for one."""

    def log_message(self, *_: object) -> None:
        pass

    def do_GET(self) -> None:
        asked = re.fullmatch(r"bytes=(\d+)-(\d*)", self.headers.get("Range", ""))
        path = self.translate_path(self.path)
        if not asked or not os.path.isfile(path):
            return super().do_GET()
        size = os.path.getsize(path)
        low, high = int(asked[1]), min(int(asked[2] or size - 1), size - 1)
        if low > high:
            return self.send_error(416)
        self.send_response(206)
        self.send_header("Content-Range", f"bytes {low}-{high}/{size}")
        self.send_header("Content-Length", str(high - low + 1))
        self.end_headers()
        with open(path, "rb") as f:
            f.seek(low)
            left = high - low + 1
            while left and (data := f.read(min(left, 1 << 20))):
                self.wfile.write(data)
                left -= len(data)


def serve(spark: SparkSession, folder: str) -> str:
    """The URL of a local folder on the driver's host; one server a folder, for the life of the process."""
    host = spark.sparkContext.getConf().get("spark.driver.host", "127.0.0.1")
    if (host, folder) not in _servers:
        server = http.server.ThreadingHTTPServer((host, 0), partial(Ranges, directory=folder))
        threading.Thread(target=server.serve_forever, daemon=True).start()
        _servers[host, folder] = f"http://{host}:{server.server_port}"
    return _servers[host, folder]


def urls(spark: SparkSession, folder: str, files: list[str]) -> list[str]:
    """URLs of files below the folder."""
    at = serve(spark, folder)
    return [f"{at}/{quote(os.path.relpath(f.removeprefix('file:').replace('//', '/'), folder))}" for f in files]
