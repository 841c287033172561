"""Queries over the given tables and their SQL; they write to a folder of their own."""

import tempfile

from cauce.shared import use_shared_dir

# Only for sessions that name no folder, as in tests on one machine.
_folder = tempfile.TemporaryDirectory(prefix="checks-", ignore_cleanup_errors=True)
use_shared_dir(_folder.name)
