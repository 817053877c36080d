import os

ROOT = os.environ.get("TESTDATA_DIR", "/root/testdata")
DATA = f"{ROOT}/sf0.001"
