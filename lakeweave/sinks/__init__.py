"""Writers. The only modules, with ``streaming``, that run jobs."""
