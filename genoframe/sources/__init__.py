"""Sources and sinks (inventory A): readers, writers and fixture views."""
