from pathlib import Path

import pytest
from test_entry import FOLDER, ROOT, SESSION, run


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_workers_need_no_installed_package(tmp_path):
    names = ["op2_licence_scan", "op4_quality_rules", "op6_byte_bpe", "op10_best_fit_packing", "op11_token_alignment", "op12_decontamination", "op13_ranked_search"]
    out = run(SESSION.format(root=str(ROOT), names=names, folder=FOLDER), tmp_path)
    assert [line for line in out if line] == [f"{n} True" for n in names]
