"""Where the tests' small tables lie (a module of its own: two conftest files share the name ``conftest``)."""

SF_SMALL = "/root/testdata/sf0.001"
