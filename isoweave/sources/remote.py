"""Files by path or URI, opened for ranged reads and for writing: local ones, and what Arrow's file systems reach (s3, gs, hdfs, ...)."""

from __future__ import annotations

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def opened(path: str):
    """A file to seek and read in."""
    system, name = located(path)
    return system.open_input_file(name)


def created(path: str):
    """A new file to write to; its folder is made."""
    system, name = located(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(name)


def size(path: str) -> int | None:
    """Bytes of a file; None where there is none."""
    system, name = located(path)
    info = system.get_file_info(name)
    return info.size if info.is_file else None


def parts(path: str, suffix: str) -> list[str]:
    """The file itself, or the files of a folder that end in suffix, by name; hidden ones don't count."""
    system, name = located(path)
    if system.get_file_info(name).is_file:
        return [path]
    prefix = path.rstrip("/")
    found = system.get_file_info(fs.FileSelector(name, recursive=False))
    return [f"{prefix}/{f.base_name}" for f in sorted(found, key=lambda f: f.base_name) if f.is_file and f.base_name.endswith(suffix) and f.base_name[0] not in "._"]


def taken(path: str) -> bool:
    """Whether a file is there, or a folder with anything in it."""
    system, name = located(path)
    info = system.get_file_info(name)
    return info.is_file or info.type == fs.FileType.Directory and bool(system.get_file_info(fs.FileSelector(name)))


def removed(path: str) -> None:
    system, name = located(path)
    kind = system.get_file_info(name).type
    if kind == fs.FileType.Directory:
        system.delete_dir(name)
    elif kind == fs.FileType.File:
        system.delete_file(name)


def moved(source: str, target: str) -> None:
    (system, a), (_, b) = located(source), located(target)
    system.move(a, b)
