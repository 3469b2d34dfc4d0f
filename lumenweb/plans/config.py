"""Settings: which stages run, and limits. A file of KEY=value lines overrides them, with types inferred."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


def infer(text: str) -> bool | int | float | str:
    """True and False, whole numbers, numbers, else text."""
    if text in ("True", "False"):
        return text == "True"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


@dataclass(frozen=True)
class Config:
    do_page_processing: bool = True
    do_classification: bool = True
    do_content_classification: bool = True
    do_social_media: bool = True
    do_mail_exchange: bool = True
    do_hcj_extraction: bool = True
    do_js_interpretation: bool = True
    do_sampling: bool = False
    sampling_rate: float = 0.001
    sampling_local_folder: str = "output/sampling"
    csv_output_delimiter: str = ","
    enable_revisiting: bool = True
    max_revisit: int = 1
    controller_limit: int = 10_000
    batch_split: int = 3
    fix_window_location: bool = False
    count_scripts: bool = True

    @classmethod
    def read(cls, lines: list[str]) -> Config:
        """Keys that aren't settings are passed over."""
        known = {f.name for f in fields(cls)}
        pairs = (x.strip().split("=", 1) for x in lines if "=" in x and not x.lstrip().startswith("#"))
        return replace(cls(), **{k.strip().lower(): infer(v.strip()) for k, v in pairs if k.strip().lower() in known})
