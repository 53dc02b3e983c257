"""Folders of the driver's tables (a module of its own: ``conftest`` is ambiguous
between test folders)."""

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"
