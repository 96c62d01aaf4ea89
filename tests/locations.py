"""Folders the tests read. Imported by name, since every test folder has a module ``conftest``."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
