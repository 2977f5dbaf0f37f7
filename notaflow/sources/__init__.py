"""Sources: the test-table adapter, landing-folder files, invoice XML, window plans."""
