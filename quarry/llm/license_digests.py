"""SHA-256 of the canonical forms (see licenses.canonical) of entire licence texts, by the licence that they are. Fixed values."""

FULL = {
    "23c0498e738b86da84fa1ffb1ff43f4ef103f365367077ada18cd1db1813d6da": "Apache-2.0",
    "98378616989e23431b15181388a001fdeac0999db741918e302c5162392bcfbd": "Apache-2.0",
    "e7c5260ee7e187aa32deaf9fe84733b5dbe1dd1f3c36f232c49799c716b73570": "Apache-2.0",
    "ebc600199db9838b4fc2d5288a12598c2702142177a89b3443f5cc87b137d94b": "Apache-2.0",
    "032f33a9fad178d38ba062bc5f6e47fde5eb48f13d4c8895fe1360e806c83a69": "BSD-2-Clause",
    "1d9bf53e362cd41e62a1d922d2efde16a95fc52b7f8a3be9bf871b5cabc6fb45": "BSD-2-Clause",
    "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2": "BSD-2-Clause",
    "33903615089fdb3ab02696d1bd92eb9580c2c7a0e0c8714aa95b0dfc1dcdb89c": "BSD-2-Clause",
    "4383e33424fc6aa46640f80aec019015d6f40e9da46cef735cb4c8a917c63da1": "BSD-2-Clause",
    "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2": "BSD-2-Clause",
    "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74": "BSD-2-Clause",
    "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30": "BSD-2-Clause",
    "b02d799e391838a73a0ccc75692ba88eafccab18abbd5f907e855d22048655d4": "BSD-2-Clause",
    "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9": "BSD-2-Clause",
    "eddcfdfb771f61c172f95c7ecd254d9c71d0a17a25bd31d82a815e6dfed10825": "BSD-2-Clause",
    "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b": "BSD-2-Clause",
    "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651": "BSD-3-Clause",
    "2e7176bc5e672ddac2a5f0fc6d960e21a16fec090b3cbc11632a75ec99e63ee9": "BSD-3-Clause",
    "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da": "BSD-3-Clause",
    "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2": "BSD-3-Clause",
    "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15": "BSD-3-Clause",
    "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded": "BSL-1.0",
    "55e91aea016ab28d7112214004573a5f32b52d59881f746d83189c7b213357f3": "BlueOak-1.0.0",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "fa5002c8ad14dab37bb2509ad12864ed13f40e748ab2b5203f9c8b9342b92cb1": "CDLA-Permissive-2.0",
    "37db86be8f16e9b8dfb0d63e1698ad2e07d54f312494c1cb2dbdb4fa37487f0f": "GFDL-1.2",
    "7befa86e5ee53162018d597eee81db6c727f3e64fab4641af93e19deab1807b4": "GFDL-1.3",
    "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc": "GPL-1.0",
    "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70": "GPL-1.0",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0",
    "a1e7ba14d8d85807f384435b77f91e925decc43da128311c991c4f2337e44017": "GPL-2.0",
    "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1": "GPL-2.0",
    "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999": "GPL-2.0",
    "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f": "GPL-3.0",
    "3d4de016a08e1d98b27dec755cdf4530b92807d97aaa185b32e12d52942b1943": "GPL-3.0",
    "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b": "GPL-3.0",
    "e00f31f158e77a60e7375307e014eeb17754967f6d6757d019567221315db4e1": "ISC",
    "fa224876c62df0b2fc8bde54e6682fed261c5669e98fcbcd614754b5f1b8e4e2": "ISC",
    "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3": "LGPL-2.0",
    "e0de5033b5ad2a24c0a1a8b04f09e33038ffa62d2bef7178de2a3c6f5d56f499": "LGPL-2.0",
    "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c": "LGPL-2.0",
    "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c": "LGPL-2.1",
    "9bf9c99aeafbdbccd7456a00d574699e3deb41868375496cacbf170be719bebd": "LGPL-2.1",
    "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345": "LGPL-2.1",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "6322cfa2f28849930d0ef51c1efc8e48782b3fd1cd03d177a9b8adfe897ed7d0": "MIT",
    "6c833965e9ca4cf8095655005226f24fe8bf7b1605dbe513204837a7371fa127": "MIT",
    "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6": "MPL-1.1",
    "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9": "MPL-2.0",
    "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229": "Unlicense",
    "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7": "Zlib",
}
