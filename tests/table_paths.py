"""Paths the tests share (a module of its own: each test folder has a ``conftest``)."""

SF_SMALL = "/root/testdata/sf0.001"
