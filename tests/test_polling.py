import http.server
import threading

import pytest

from geotide.sources.polling import PollingReader, Token

ISSUED = []


@pytest.fixture
def server():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            ok = self.headers.get("Authorization") == "Bearer t"
            self.send_response(200 if ok else 403)
            self.end_headers()
            self.wfile.write(b'{"time": 1, "states": []}')

        def do_POST(self):
            ISSUED.append(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b'{"access_token": "t", "expires_in": 600}')

        def log_message(self, *args):
            pass

    s = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/"
    s.shutdown()


def test_fetches_at_most_once_an_interval(server):
    reader = PollingReader({"url": server, "interval": "60", "token": "t"})
    rows, at = reader.read(reader.initialOffset())
    assert next(rows)[0].startswith('{"time"') and at == {"fetches": 1}
    assert list(reader.read(at)[0]) == [] and len(list(reader.readBetweenOffsets({"fetches": 0}, at))) == 1
    reader.commit(at)
    with pytest.raises(RuntimeError, match="spool"):
        reader.readBetweenOffsets({"fetches": 0}, at)


def test_a_spooled_fetch_outlives_the_reader(server, tmp_path):
    options = {"url": server, "token": "t", "spool": str(tmp_path / "spool")}
    rows, at = PollingReader(options).read({"fetches": 0})
    again = PollingReader(options)
    assert list(again.readBetweenOffsets({"fetches": 0}, at)) == list(rows)
    again.commit(at)
    assert not list((tmp_path / "spool").iterdir())


def test_token_is_fetched_once(server):
    issuer = Token(server + "token", "me", "secret")
    assert issuer.get() == issuer.get() == "t" and ISSUED == [b"grant_type=client_credentials&client_id=me&client_secret=secret"]
    rows, _ = PollingReader({"url": server, "token_url": server + "token", "client_id": "me", "client_secret": "secret"}).read({"fetches": 0})
    assert next(rows)[0].startswith('{"time"')


def test_other_answers_fail(server):
    with pytest.raises(Exception, match="403"):
        PollingReader({"url": server}).read({"fetches": 0})
